"""Merchant statistics and customer–merchant affinity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.columns import DEFAULT, TxColumns
from tallygrain.operators.joins import Lookup, build_lookup, lookup_join
from tallygrain.session import materialize

MERCHANT_FEATURES = [
    "merchant_avg_amount",
    "merchant_std_amount",
    "merchant_tx_count",
    "merchant_fraud_rate",
    "customer_merchant_affinity",
]
ZERO_WHEN_UNSEEN = ["merchant_avg_amount", "merchant_std_amount", "merchant_tx_count"]


def merchant_statistics(df: DataFrame, cols: TxColumns = DEFAULT, with_fraud: bool = True) -> DataFrame:
    aggregates = [
        F.avg(cols.amount).alias("merchant_avg_amount"),
        F.stddev_samp(cols.amount).alias("merchant_std_amount"),
        F.count(cols.amount).alias("merchant_tx_count"),
    ]
    if with_fraud and cols.fraud in df.columns:
        aggregates.append(F.avg(F.col(cols.fraud).cast("int")).alias("merchant_fraud_rate"))
    return df.where(F.col(cols.provider).isNotNull()).groupBy(cols.provider).agg(*aggregates)


def pair_statistics(df: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    """One written row per customer and merchant.

    The one aggregation over the transactions: shares, totals and merchant statistics all
    come from its result.
    """
    amount = F.col(cols.amount)
    fraud = [F.sum(F.col(cols.fraud).cast("int")).alias("frauds"), F.count(cols.fraud).alias("judged")] if cols.fraud in df.columns else []
    pairs, _ = materialize(
        df.where(F.col(cols.customer).isNotNull() | F.col(cols.provider).isNotNull())
        .groupBy(cols.customer, cols.provider)
        .agg(
            F.count("*").alias("tx_count"),
            F.count(amount).alias("n"),
            F.avg(amount).alias("mean"),
            F.coalesce(F.var_pop(amount), F.lit(0.0)).alias("variance"),
            *fraud,
        ),
        "pairs",
    )
    return pairs


def merchants_of_pairs(pairs: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    """Merchant statistics merged from those of the pairs.

    The merchants' means come first and squared deviations are merged around them, so that
    large amounts of little spread keep their digits.
    """
    pairs = pairs.where(F.col(cols.provider).isNotNull())
    total = F.sum("n")
    means, _ = materialize(
        pairs.groupBy(cols.provider).agg((F.sum(F.col("n") * F.col("mean")) / F.nullif(total, F.lit(0))).alias("merchant_avg_amount")), "merchant-means"
    )
    pairs = pairs.join(means, cols.provider)
    away = F.coalesce(F.col("mean") - F.col("merchant_avg_amount"), F.lit(0.0))
    squares = F.sum(F.col("n") * (F.col("variance") + away * away))
    aggregates = [
        F.first("merchant_avg_amount").alias("merchant_avg_amount"),
        F.when(total > 1, F.sqrt(squares / F.nullif(total - 1, F.lit(0)))).alias("merchant_std_amount"),
        total.alias("merchant_tx_count"),
    ]
    if "frauds" in pairs.columns:
        aggregates.append((F.sum("frauds") / F.nullif(F.sum("judged"), F.lit(0))).alias("merchant_fraud_rate"))
    return pairs.groupBy(cols.provider).agg(*aggregates)


def merchant_affinity(df: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    """Share of a customer's transactions that went to each merchant.

    Pairs without a merchant count towards the customer's total only.
    """
    return affinity_of_pairs(pair_statistics(df.select(cols.customer, cols.provider, cols.amount), cols), cols)


def affinity_of_pairs(pairs: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    pairs = pairs.where(F.col(cols.customer).isNotNull()).select(cols.customer, cols.provider, "tx_count")
    totals = pairs.groupBy(cols.customer).agg(F.sum("tx_count").alias("total_tx"))
    return (
        pairs.where(F.col(cols.provider).isNotNull())
        .join(totals, cols.customer)
        .withColumn("affinity", F.col("tx_count") / F.col("total_tx"))
    )


class MerchantProfiles:
    """Fit merchant tables on past transactions, add them to any transactions."""

    def __init__(self, merchants: Lookup, affinity: Lookup, cols: TxColumns, with_fraud: bool):
        self.merchants = merchants
        self.affinity = affinity
        self.cols = cols
        self.with_fraud = with_fraud

    @classmethod
    def fit(cls, df: DataFrame, cols: TxColumns = DEFAULT) -> MerchantProfiles:
        per_pair = pair_statistics(df, cols)
        stats = build_lookup(merchants_of_pairs(per_pair, cols), [cols.provider], "merchants", "merchant_tx_count")
        share = affinity_of_pairs(per_pair, cols).select(
            cols.customer, cols.provider, "tx_count", F.col("affinity").alias("customer_merchant_affinity")
        )
        pairs = build_lookup(share, [cols.customer, cols.provider], "affinity", "tx_count")
        return cls(stats, pairs, cols, cols.fraud in df.columns)

    def feature_names(self) -> list[str]:
        return [c for c in MERCHANT_FEATURES if self.with_fraud or c != "merchant_fraud_rate"]

    def transform(self, df: DataFrame, **join_options) -> DataFrame:
        """Unseen merchants get 0; the affinity of an unseen pair stays NULL."""
        names = self.feature_names()
        rows = df.drop(*[c for c in names if c in df.columns])
        joined = lookup_join(rows, self.merchants, **join_options)
        joined = lookup_join(joined, self.affinity, **join_options).drop("tx_count")
        return joined.fillna(0, subset=ZERO_WHEN_UNSEEN)
