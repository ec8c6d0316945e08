"""Amount, score and segment expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Amount classes (lower bound inclusive) and their labels.
AMOUNT_BOUNDS = [0, 100, 500, 1000, 5000]
AMOUNT_LABELS = ["0-100", "100-500", "500-1000", "1000-5000", "5000+"]

# Upper bounds of the score segments and their labels.
SEGMENT_BOUNDS = [4, 8, 12, 15]
SEGMENT_LABELS = ["Low", "Medium", "High", "Top"]

# Risk categories by score.
RISK_BOUNDS = [0.3, 0.7]
RISK_LABELS = ["LOW", "MEDIUM", "HIGH"]


def amount_class(value: Column) -> Column:
    """Ordinal 0..4 of the amount class; negative and missing amounts give NULL."""
    expr = F.lit(None).cast("int")
    for i, bound in enumerate(AMOUNT_BOUNDS):
        expr = F.when(value >= bound, F.lit(i)).otherwise(expr)
    return expr


def amount_label(ordinal: Column) -> Column:
    expr = F.lit(None).cast("string")
    for i, label in enumerate(AMOUNT_LABELS):
        expr = F.when(ordinal == i, label).otherwise(expr)
    return expr


def amount_category(value: Column) -> Column:
    return amount_label(amount_class(value))


def segment(score: Column) -> Column:
    """Segment of an RFM score: (0,4], (4,8], (8,12], (12,15]."""
    expr = F.when((score >= 0) & (score <= SEGMENT_BOUNDS[0]), SEGMENT_LABELS[0])
    for bound, label in zip(SEGMENT_BOUNDS[1:], SEGMENT_LABELS[1:]):
        expr = expr.when((score > 0) & (score <= bound), label)
    return expr


def risk_category(score: Column) -> Column:
    return (
        F.when(score < RISK_BOUNDS[0], RISK_LABELS[0])
        .when(score < RISK_BOUNDS[1], RISK_LABELS[1])
        .when(score.isNotNull(), RISK_LABELS[2])
    )


def is_credit(amount: Column) -> Column:
    return F.coalesce(amount > 0, F.lit(False)).cast("int")


def is_debit(amount: Column) -> Column:
    return F.coalesce(amount < 0, F.lit(False)).cast("int")


def add_amount_features(df: DataFrame, amount: str) -> DataFrame:
    a = F.col(amount)
    return df.withColumns(
        {
            "is_credit": is_credit(a),
            "is_debit": is_debit(a),
            "amount_abs": F.abs(a),
            "amount_log": F.log1p(F.abs(a)),
        }
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient with 0 where the denominator is 0 (infinity replaced)."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / F.nullif(denominator, F.lit(0)))


def smoothed_log_ratio(good: Column, bad: Column, total_good: Column, total_bad: Column) -> Column:
    """Weight of evidence of one bin with half-count smoothing."""
    return F.log(((good + 0.5) / (total_good + 1)) / ((bad + 0.5) / (total_bad + 1)))
