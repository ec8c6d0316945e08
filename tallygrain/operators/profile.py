"""Customer profiles and joining them back to transactions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.columns import DEFAULT, TxColumns
from tallygrain.functions.amounts import is_credit, is_debit
from tallygrain.functions.timefeat import micros
from tallygrain.operators.joins import Lookup, build_lookup, lookup_join
from tallygrain.operators.rfm import days_before, snapshot_micros

# What a customer without history gets.
UNSEEN_DEFAULTS = {
    "recency_days": 365,
    "days_since_first_tx": 365,
    "transaction_count": 0,
    "total_amount": 0.0,
    "avg_amount": 0.0,
    "max_amount": 0.0,
    "min_amount": 0.0,
    "std_amount": 0.0,
    "avg_tx_per_day": 0.0,
    "credit_ratio": 0.0,
    "debit_ratio": 0.0,
    "fraud_rate": 0.0,
    "fraud_count": 0,
    "unique_days": 1,
}

# Profile features in output order.
PROFILE_FEATURES = [
    "recency_days",
    "transaction_count",
    "total_amount",
    "avg_amount",
    "max_amount",
    "min_amount",
    "std_amount",
    "days_since_first_tx",
    "avg_tx_per_day",
    "credit_ratio",
    "debit_ratio",
    "unique_days",
    "fraud_rate",
    "fraud_count",
]


def customer_profile(df: DataFrame, cols: TxColumns = DEFAULT, reference: datetime | None = None) -> DataFrame:
    """All profile columns from a single aggregation."""
    moment = snapshot_micros(df, cols.time, reference)
    amount, time = F.col(cols.amount), F.col(cols.time)
    credit, debit = is_credit(amount), is_debit(amount)
    aggregates = [
        F.max(micros(time)).alias("last_us"),
        F.min(micros(time)).alias("first_us"),
        F.count(cols.time).alias("transaction_count"),
        F.count_distinct(F.to_date(time)).alias("unique_days"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("total_amount"),
        F.avg(amount).alias("avg_amount"),
        F.max(amount).alias("max_amount"),
        F.min(amount).alias("min_amount"),
        F.stddev_samp(amount).alias("std_amount"),
        F.sum(credit).alias("credit_count"),
        F.avg(credit).alias("credit_ratio"),
        F.sum(debit).alias("debit_count"),
        F.avg(debit).alias("debit_ratio"),
    ]
    if cols.fraud in df.columns:
        fraud = F.col(cols.fraud).cast("int")
        aggregates += [F.coalesce(F.sum(fraud), F.lit(0)).alias("fraud_count"), F.avg(fraud).alias("fraud_rate")]
    table = df.where(F.col(cols.customer).isNotNull()).groupBy(cols.customer).agg(*aggregates)
    first = days_before(moment, F.col("first_us"))
    return table.withColumns(
        {
            "recency_days": days_before(moment, F.col("last_us")),
            "days_since_first_tx": first,
            "avg_tx_per_day": F.col("transaction_count") / (first + 1),
        }
    ).drop("last_us", "first_us")


class CustomerProfiles:
    """Fit profiles on past transactions, add them to any transactions."""

    def __init__(self, lookup: Lookup, cols: TxColumns = DEFAULT):
        self.lookup = lookup
        self.cols = cols

    @classmethod
    def fit(cls, df: DataFrame, cols: TxColumns = DEFAULT, reference: datetime | None = None) -> CustomerProfiles:
        profile = customer_profile(df, cols, reference)
        kept = [c for c in PROFILE_FEATURES if c in profile.columns]
        table = profile.select(cols.customer, *kept)
        return cls(build_lookup(table, [cols.customer], "profiles", "transaction_count"), cols)

    def transform(self, df: DataFrame, **join_options) -> DataFrame:
        """Rows with their customer's profile; unseen customers get the defaults."""
        clashing = [c for c in PROFILE_FEATURES if c in df.columns]
        joined = lookup_join(df.drop(*clashing), self.lookup, **join_options)
        filled = {}
        for name, default in UNSEEN_DEFAULTS.items():
            filled[name] = (
                F.coalesce(F.col(name), F.lit(default)) if name in joined.columns else F.lit(default)
            )
        return joined.withColumns(filled)
