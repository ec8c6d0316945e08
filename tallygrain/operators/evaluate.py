"""Exact evaluation tables of a binary classifier."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallygrain.session import materialize

# Costs of the two kinds of error, the F1 guard and the probability clip.
COST_FALSE_NEGATIVE, COST_FALSE_POSITIVE = 10, 2
F1_GUARD = 1e-10
PROBABILITY_CLIP = 2.220446049250313e-16

RANGE_ROWS = 1_000_000  # distinct scores that one task sums


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: true_negatives, false_positives, false_negatives, true_positives."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(~y & ~p).alias("true_negatives"),
        F.count_if(~y & p).alias("false_positives"),
        F.count_if(y & ~p).alias("false_negatives"),
        F.count_if(y & p).alias("true_positives"),
    )


def class_metrics(counts: DataFrame) -> DataFrame:
    """Rates, error cost and class ratio from confusion counts; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives"))
    total = tn + fp + fn + tp

    def ratio(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a / F.nullif(b, F.lit(0)))

    return counts.withColumns(
        {
            "accuracy": ratio(tp + tn, total),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
            "f2": ratio(5 * tp, 5 * tp + 4 * fn + fp),
            "cost_of_errors": COST_FALSE_NEGATIVE * fn + COST_FALSE_POSITIVE * fp,
            "class_ratio": ratio(tp + fn, total),
            "n_samples": total,
        }
    )


def log_loss(df: DataFrame, label: str, score: str) -> DataFrame:
    p = F.greatest(F.least(F.col(score), F.lit(1 - PROBABILITY_CLIP)), F.lit(PROBABILITY_CLIP))
    loss = F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return df.where(F.col(score).isNotNull()).agg(F.avg(loss).alias("log_loss"))


@dataclass(frozen=True)
class ScoreTable:
    """Positives and negatives per distinct score, written once, with the totals."""

    table: DataFrame
    rows: int
    positives: int
    negatives: int


def score_table(df: DataFrame, label: str, score: str) -> ScoreTable:
    grouped = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    table, seen = materialize(
        grouped, "scores", {"rows": F.count(F.lit(1)), "pos": F.sum("pos"), "neg": F.sum("neg")}
    )
    return ScoreTable(table, seen["rows"], seen["pos"] or 0, seen["neg"] or 0)


def running_counts(scores: ScoreTable, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Adds tp and fp: positives and negatives with this score or a higher one.

    The distinct scores are cut into ranges of about ``range_rows``; each range is summed by its
    own task and shifted by the totals of the ranges above it (one row per range).
    """
    order = F.col("score").desc()
    ranges = math.ceil(scores.rows / range_rows) + 1
    points = [i / ranges for i in range(1, ranges)]
    accuracy = max(10_000, 10 * ranges)
    cuts = scores.table.agg(F.percentile_approx("score", points, accuracy).alias("q")).first()["q"]
    splits = [-math.inf, *(sorted(set(cuts or [])) or [0.0]), math.inf]
    bucketed = Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(scores.table)
    above = W.partitionBy(F.lit(0)).orderBy(F.col("bucket").desc()).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("bucket")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(
            "bucket",
            F.coalesce(F.sum("p").over(above), F.lit(0)).alias("pos_above"),
            F.coalesce(F.sum("n").over(above), F.lit(0)).alias("neg_above"),
        )
    )
    w = W.partitionBy("bucket").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = bucketed.withColumns({"tp": F.sum("pos").over(w), "fp": F.sum("neg").over(w)})
    return (
        inner.join(offsets, "bucket")
        .withColumns({"tp": F.col("tp") + F.col("pos_above"), "fp": F.col("fp") + F.col("neg_above")})
        .drop("bucket", "pos_above", "neg_above")
    )


def curve(scores: ScoreTable, **options) -> DataFrame:
    """One row per threshold: tpr, fpr, precision, recall and F1."""
    p, n = F.lit(max(scores.positives, 1)), F.lit(max(scores.negatives, 1))
    points = running_counts(scores, **options)
    recall, precision = F.col("tp") / p, F.col("tp") / (F.col("tp") + F.col("fp"))
    return points.select(
        F.col("score").alias("threshold"),
        "pos",
        "neg",
        "tp",
        "fp",
        recall.alias("tpr"),
        (F.col("fp") / n).alias("fpr"),
        precision.alias("precision"),
        recall.alias("recall"),
        (2 * precision * recall / (precision + recall + F1_GUARD)).alias("f1"),
    )


def ranking_metrics(scores: ScoreTable, **options) -> DataFrame:
    """One row: roc_auc, average_precision, ks_statistic, best_threshold, best_f1.

    Equal scores count half in the area, the precision is summed in steps, and the
    best threshold is the lowest of those with the highest F1.
    """
    p, n = scores.positives, scores.negatives
    points = curve(scores, **options)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    best = F.max(F.struct("f1", (-F.col("threshold")).alias("t")))
    out = points.agg(
        (area / F.lit(float(p) * float(n)) if p and n else F.lit(None).cast("double")).alias("roc_auc"),
        F.sum(F.col("pos") / F.lit(max(p, 1)) * F.col("precision")).alias("average_precision"),
        F.greatest(F.lit(0.0), F.max(F.col("tpr") - F.col("fpr"))).alias("ks_statistic"),
        best.alias("best"),
    )
    return out.select(
        "roc_auc",
        "average_precision",
        "ks_statistic",
        (-F.col("best.t")).alias("best_threshold"),
        F.col("best.f1").alias("best_f1"),
    )


def evaluate(
    df: DataFrame, label: str, prediction: str, score: str | None = None, prefix: str = ""
) -> dict[str, float]:
    """All metrics of one scored table as a dictionary, names with an optional prefix."""
    row = class_metrics(confusion(df, label, prediction)).first().asDict()
    if score is not None:
        row |= ranking_metrics(score_table(df, label, score)).first().asDict()
        row |= log_loss(df, label, score).first().asDict()
    return {f"{prefix}{name}": value for name, value in row.items()}


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy(F.lit(0)))
    return counts.withColumn("share", F.col("n") / total)
