"""Shapley attributions by permutation sampling, as one scored table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallygrain.operators.split import sample_rows
from tallygrain.operators.train import predictions
from tallygrain.session import materialize


def background_table(df: DataFrame, key: str, columns: list[str], rows: int = 100, seed: int = 42) -> DataFrame:
    """(_slot, _base): a repeatable sample of at most ``rows`` rows that stand for the usual customer."""
    sample = sample_rows(df, key, rows, seed).select(F.struct(key, F.struct(*columns).alias("base")).alias("r"))
    # One array of ``rows`` entries at most.
    return sample.agg(F.array_sort(F.collect_list("r")).alias("all")).select(F.posexplode("all").alias("_slot", "r")).select("_slot", F.col("r.base").alias("_base"))


def expected_value(model: PipelineModel, background: DataFrame) -> float:
    """The mean score of the background: attributions explain how far a row lies from it."""
    return predictions(model, background.select("_base.*")).agg(F.avg("risk_score")).first()[0]


def shapley_values(
    model: PipelineModel,
    df: DataFrame,
    key: str,
    columns: list[str],
    background: DataFrame | None = None,
    n_samples: int | None = None,
    permutations: int = 10,
    seed: int = 42,
) -> DataFrame:
    """(key, feature, shapley): contributions that add up to score minus background score.

    For every explained row and permutation one row of ``background`` (from ``background_table``,
    by default of ``df``) is drawn. Walking through the permutation, each step takes one more
    feature from the explained row; the change of the score is that feature's contribution. All
    rows are explained, or a repeatable sample of ``n_samples`` where that is asked for.
    """
    sample = (df if n_samples is None else sample_rows(df, key, n_samples, seed)).select(key, *columns)
    background, seen = materialize(background_table(df, key, columns, seed=seed) if background is None else background, "background", {"n": F.count(F.lit(1))})
    size = max(1, seen["n"])
    width = len(columns)
    walks = (
        sample.withColumn("_walk", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
        .withColumn("_slot", F.pmod(F.xxhash64(key, "_walk", F.lit(seed)), F.lit(size)).cast("int"))
        .join(F.broadcast(background), "_slot")
    )
    # A permutation is the order of the hashes of the feature numbers.
    marks = F.array_sort(
        F.array(
            *[F.struct(F.xxhash64(key, "_walk", F.lit(i), F.lit(seed)).alias("h"), F.lit(i).alias("i")) for i in range(width)]
        )
    )
    steps = walks.withColumn("_order", F.transform(marks, lambda m: m["i"])).withColumn(
        "_step", F.explode(F.sequence(F.lit(0), F.lit(width)))
    )
    mixed = steps
    for i, c in enumerate(columns):
        taken = F.array_position("_order", i) <= F.col("_step")
        mixed = mixed.withColumn(f"_m{i}", F.when(taken, F.col(c)).otherwise(F.col(f"_base.{c}")))
    mixed = mixed.select(
        key, "_walk", "_step", "_order", *[F.col(f"_m{i}").alias(c) for i, c in enumerate(columns)]
    )
    scored = predictions(model, mixed).select(key, "_walk", "_step", "_order", "risk_score")
    along = W.partitionBy(key, "_walk").orderBy("_step")
    change = scored.withColumn("gain", F.col("risk_score") - F.lag("risk_score").over(along)).where(F.col("_step") > 0)
    names = F.array(*[F.lit(c) for c in columns])
    return (
        change.withColumn("feature", F.get(names, F.get("_order", F.col("_step") - 1)))
        .groupBy(key, "feature")
        .agg(F.avg("gain").alias("shapley"))
    )


def shapley_importance(values: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return (
        values.groupBy("feature")
        .agg(F.avg(F.abs("shapley")).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )
