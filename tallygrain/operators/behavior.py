"""Behaviour features per customer, and the wide customer table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.columns import DEFAULT, TxColumns
from tallygrain.functions.amounts import AMOUNT_LABELS, amount_label, safe_ratio
from tallygrain.functions.timefeat import MICROS_PER_DAY, micros
from tallygrain.operators.rfm import days_before, money, score_customers, snapshot_micros, to_micros, with_rfm_metrics
from tallygrain.session import materialize

BEHAVIOR_COLUMNS = [
    "TotalTransactions",
    "TotalSpend",
    "AvgTransactionValue",
    "StdTransactionValue",
    "MinTransactionValue",
    "MaxTransactionValue",
    "UniqueTransactionDays",
    "UniqueProductCategories",
    "UniqueProviders",
    "UniqueChannels",
    "MostActiveDay",
    "MostActiveHour",
    "MostCommonAmountCategory",
    "TransactionFrequency",
    "CustomerLifetime",
    "AvgDaysBetweenTransactions",
    "DaysSinceFirstTransactionDate",
    "DaysSinceLastTransactionDate",
]

# Feature columns of the wide customer table, in order.
FEATURE_NAMES = [
    "Recency",
    "Frequency",
    "Monetary",
    "AvgTransactionValue_x",
    "MaxTransactionValue_x",
    "MonetaryPerFrequency",
    "RecencyScore",
    "FrequencyScore",
    "MonetaryScore",
    "RFM_Score",
    "TotalTransactions",
    "TotalSpend",
    "AvgTransactionValue_y",
    "StdTransactionValue",
    "MinTransactionValue",
    "MaxTransactionValue_y",
    "UniqueTransactionDays",
    "UniqueProductCategories",
    "UniqueProviders",
    "UniqueChannels",
    "MostActiveDay",
    "MostActiveHour",
    "TransactionFrequency",
    "CustomerLifetime",
    "AvgDaysBetweenTransactions",
    "DaysSinceFirstTransactionDate",
    "DaysSinceLastTransactionDate",
    "RFM_Segment",
]


def small_domain_mode(ordinal: Column, size: int) -> Column:
    """Most frequent of the ordinals 0..size-1, the smallest on ties.

    Counting each value in its own sum keeps the aggregation a code-generated
    hash aggregation with map-side combine; count and value share one number so
    that the largest count with the smallest value wins.
    """
    width = 64
    votes = [
        F.coalesce(F.sum((ordinal == i).cast("long")), F.lit(0)) * width + (width - 1 - i) for i in range(size)
    ]
    best = F.greatest(*votes)
    return F.when(best >= width, (F.lit(width - 1) - best % width).cast("int"))


def activity_aggregates(cols: TxColumns, money_scale: int | None = None) -> list[Column]:
    value = F.col(cols.value)
    return [
        F.count(cols.transaction).alias("TotalTransactions"),
        money(F.coalesce(F.sum(value), F.lit(0.0)), money_scale).alias("TotalSpend"),
        F.avg(value).alias("AvgTransactionValue"),
        F.stddev_samp(value).alias("StdTransactionValue"),
        F.min(value).alias("MinTransactionValue"),
        F.max(value).alias("MaxTransactionValue"),
        F.min(micros(F.col(cols.time))).alias("first_us"),
        F.max(micros(F.col(cols.time))).alias("last_us"),
        small_domain_mode(F.col("DayOfWeek"), 7).alias("MostActiveDay"),
        small_domain_mode(F.col("HourOfDay"), 24).alias("MostActiveHour"),
        amount_label(small_domain_mode(F.col("AmountClass"), len(AMOUNT_LABELS))).alias("MostCommonAmountCategory"),
    ]


def variety(df: DataFrame, cols: TxColumns) -> DataFrame:
    """Distinct counts per customer.

    Kept apart from the other aggregates: alone, the distinct values combine on
    the map side and shuffle by (customer, value), so a dominant customer spreads
    over all tasks. Note that UniqueTransactionDays counts distinct timestamps.
    """
    return df.groupBy(cols.customer).agg(
        F.count_distinct(cols.time).alias("UniqueTransactionDays"),
        F.count_distinct(cols.category).alias("UniqueProductCategories"),
        F.count_distinct(cols.provider).alias("UniqueProviders"),
        F.count_distinct(cols.channel).alias("UniqueChannels"),
    )


def customer_statistics(
    cleaned: DataFrame, cols: TxColumns = DEFAULT, money_scale: int | None = None, extra: list[Column] = ()
) -> DataFrame:
    """All per-customer aggregates; both sides are partitioned by customer already."""
    known = cleaned.where(F.col(cols.customer).isNotNull())
    activity = known.groupBy(cols.customer).agg(*activity_aggregates(cols, money_scale), *extra)
    return activity.join(variety(known, cols), cols.customer, "inner")


def with_behavior(table: DataFrame, snapshot: int) -> DataFrame:
    """Ratios, lifetime and days since first and last transaction."""
    lifetime = F.floor((F.col("last_us") - F.col("first_us")) / F.lit(MICROS_PER_DAY)).cast("long")
    return table.withColumns(
        {
            "TransactionFrequency": safe_ratio(F.col("TotalTransactions"), F.col("UniqueTransactionDays")),
            "CustomerLifetime": lifetime,
            "AvgDaysBetweenTransactions": safe_ratio(lifetime, F.col("TotalTransactions")),
            "DaysSinceFirstTransactionDate": days_before(snapshot, F.col("first_us")),
            "DaysSinceLastTransactionDate": days_before(snapshot, F.col("last_us")),
        }
    )


def behavior_features(
    cleaned: DataFrame, cols: TxColumns = DEFAULT, snapshot: datetime | None = None, money_scale: int | None = None
) -> DataFrame:
    """Behaviour features of cleaned transactions (see ``clean_customer_path``)."""
    moment = snapshot_micros(cleaned, cols.time, snapshot)
    table = with_behavior(customer_statistics(cleaned, cols, money_scale), moment)
    return table.select(cols.customer, *BEHAVIOR_COLUMNS)


def fraud_history(df: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    """Label 1 when a customer has any fraudulent transaction."""
    return (
        df.where(F.col(cols.customer).isNotNull())
        .groupBy(cols.customer)
        .agg(F.max(F.col(cols.fraud).cast("int")).alias("is_high_risk"))
    )


def wide_base(
    cleaned: DataFrame, cols: TxColumns = DEFAULT, snapshot: datetime | None = None, money_scale: int | None = None
) -> tuple[DataFrame, int]:
    """RFM and behaviour columns from one pass over the transactions, written once.

    The metrics shared by both feature sets come from the same aggregates; the
    ``_x``/``_y`` pairs are therefore equal by construction.
    """
    extra = [F.max(F.col(cols.fraud).cast("int")).alias("had_fraud")] if cols.fraud in cleaned.columns else []
    stats = customer_statistics(cleaned, cols, money_scale, extra)
    table, seen = materialize(stats, "customers", {"rows": F.count(F.lit(1)), "latest": F.max("last_us")})
    if snapshot is None and seen["latest"] is None:
        raise ValueError("no transaction has a time, so there is no snapshot date")
    moment = to_micros(snapshot) if snapshot is not None else seen["latest"] + MICROS_PER_DAY
    shared = table.withColumns({"Frequency": F.col("TotalTransactions"), "Monetary": F.col("TotalSpend")})
    return with_behavior(with_rfm_metrics(shared, moment), moment), seen["rows"]


def finish_wide(scored: DataFrame, label: Column, cols: TxColumns = DEFAULT) -> DataFrame:
    """Name, order and fill the feature columns and attach the label."""
    named = scored.withColumns(
        {
            "AvgTransactionValue_x": F.col("AvgTransactionValue"),
            "AvgTransactionValue_y": F.col("AvgTransactionValue"),
            "MaxTransactionValue_x": F.col("MaxTransactionValue"),
            "MaxTransactionValue_y": F.col("MaxTransactionValue"),
            "is_high_risk": label,
        }
    )
    numbers = [c for c in FEATURE_NAMES if c != "RFM_Segment"]
    return named.select(cols.customer, *FEATURE_NAMES, "is_high_risk").fillna(0, subset=[*numbers, "is_high_risk"])


def customer_wide_by_fraud(
    cleaned: DataFrame, cols: TxColumns = DEFAULT, snapshot: datetime | None = None, money_scale: int | None = None
) -> DataFrame:
    """Wide customer table with the fraud-history label."""
    table, _ = wide_base(cleaned, cols, snapshot, money_scale)
    return finish_wide(score_customers(table, cols.customer), F.col("had_fraud"), cols)
