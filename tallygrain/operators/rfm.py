"""Recency, frequency and monetary metrics, scores and segments."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.columns import DEFAULT, TxColumns
from tallygrain.functions.amounts import segment
from tallygrain.functions.timefeat import MICROS_PER_DAY, micros
from tallygrain.operators.binning import Score, fit_scores
from tallygrain.session import materialize

# Weights of the weighted score.
RECENCY_WEIGHT, FREQUENCY_WEIGHT, MONETARY_WEIGHT = 0.4, 0.3, 0.3

CUSTOMER_SCORES = [
    Score("Recency", "RecencyScore", "value", descending=True),
    Score("Frequency", "FrequencyScore", "rank"),
    Score("Monetary", "MonetaryScore", "value"),
]
TARGET_SCORES = [
    Score("recency", "recency_score", "value", descending=True),
    Score("frequency", "frequency_score", "rank"),
    Score("monetary", "monetary_score", "rank"),
]


def to_micros(moment: datetime) -> int:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def snapshot_micros(df: DataFrame, time: str, snapshot: datetime | None = None) -> int:
    """The given snapshot, else the latest transaction plus one day."""
    if snapshot is not None:
        return to_micros(snapshot)
    latest = df.agg(F.max(micros(F.col(time))).alias("t")).first()["t"]
    if latest is None:
        raise ValueError("no transaction has a time, so there is no snapshot date")
    return latest + MICROS_PER_DAY


def days_before(snapshot: int, moment_micros: Column) -> Column:
    return F.floor((F.lit(snapshot) - moment_micros) / F.lit(MICROS_PER_DAY)).cast("long")


def money(column: Column, scale: int | None) -> Column:
    return column if scale is None else F.round(column, scale)


def rfm_base(
    df: DataFrame, cols: TxColumns = DEFAULT, snapshot: datetime | None = None, money_scale: int | None = None
) -> tuple[DataFrame, int]:
    """One row per customer with the RFM metrics, written once, plus the row count.

    The latest time is taken from the written table, so the transactions are
    scanned once.
    """
    grouped = (
        df.where(F.col(cols.customer).isNotNull())
        .groupBy(cols.customer)
        .agg(
            F.max(micros(F.col(cols.time))).alias("last_us"),
            F.count(cols.transaction).alias("Frequency"),
            money(F.coalesce(F.sum(cols.value), F.lit(0.0)), money_scale).alias("Monetary"),
            F.avg(cols.value).alias("AvgTransactionValue"),
            F.max(cols.value).alias("MaxTransactionValue"),
        )
    )
    table, seen = materialize(grouped, "rfm", {"rows": F.count(F.lit(1)), "latest": F.max("last_us")})
    if snapshot is None and seen["latest"] is None:
        raise ValueError("no transaction has a time, so there is no snapshot date")
    moment = to_micros(snapshot) if snapshot is not None else seen["latest"] + MICROS_PER_DAY
    return with_rfm_metrics(table, moment).drop("last_us"), seen["rows"]


def with_rfm_metrics(table: DataFrame, snapshot: int) -> DataFrame:
    return table.withColumns(
        {
            "Recency": days_before(snapshot, F.col("last_us")),
            "MonetaryPerFrequency": F.col("Monetary") / F.nullif(F.col("Frequency"), F.lit(0)),
        }
    )


def score_customers(table: DataFrame, customer: str, **tuning) -> DataFrame:
    """Quintile scores, their sum and the segment for a customer table."""
    scored = table.withColumns(fit_scores(table, customer, CUSTOMER_SCORES, **tuning))
    total = F.col("RecencyScore") + F.col("FrequencyScore") + F.col("MonetaryScore")
    return scored.withColumn("RFM_Score", total).withColumn("RFM_Segment", segment(F.col("RFM_Score")))


def rfm_table(
    df: DataFrame, cols: TxColumns = DEFAULT, snapshot: datetime | None = None, money_scale: int | None = None
) -> DataFrame:
    """Metrics, scores and segment per customer: the customer path."""
    table, _ = rfm_base(df, cols, snapshot, money_scale)
    return score_customers(table, cols.customer)


def target_rfm_base(
    df: DataFrame, cols: TxColumns = DEFAULT, snapshot: datetime | None = None, money_scale: int | None = None
) -> tuple[DataFrame, int]:
    """Target path: recency, row count and signed amount per customer."""
    grouped = (
        df.where(F.col(cols.customer).isNotNull())
        .groupBy(cols.customer)
        .agg(
            F.max(micros(F.col(cols.time))).alias("last_us"),
            F.count(F.lit(1)).alias("frequency"),
            money(F.coalesce(F.sum(cols.amount), F.lit(0.0)), money_scale).alias("monetary"),
        )
    )
    table, seen = materialize(grouped, "target-rfm", {"rows": F.count(F.lit(1)), "latest": F.max("last_us")})
    if snapshot is None and seen["latest"] is None:
        raise ValueError("no transaction has a time, so there is no snapshot date")
    moment = to_micros(snapshot) if snapshot is not None else seen["latest"] + MICROS_PER_DAY
    return table.withColumn("recency", days_before(moment, F.col("last_us"))).drop("last_us"), seen["rows"]


def weighted_score(weights: tuple[float, float, float]) -> Column:
    r, f, m = weights
    return F.col("recency_score") * r + F.col("frequency_score") * f + F.col("monetary_score") * m


def target_rfm_table(
    df: DataFrame,
    cols: TxColumns = DEFAULT,
    snapshot: datetime | None = None,
    weights: tuple[float, float, float] = (RECENCY_WEIGHT, FREQUENCY_WEIGHT, MONETARY_WEIGHT),
    money_scale: int | None = None,
    on_duplicate: str = "error",
) -> tuple[DataFrame, int]:
    """Metrics, three scores and the weighted score per customer."""
    table, rows = target_rfm_base(df, cols, snapshot, money_scale)
    scored = table.withColumns(fit_scores(table, cols.customer, TARGET_SCORES, on_duplicate=on_duplicate))
    return scored.withColumn("rfm_score", weighted_score(weights)), rows
