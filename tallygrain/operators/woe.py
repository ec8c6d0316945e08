"""Weight of evidence: quantile bins of numeric columns against a 0/1 label."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.columns import numeric_columns
from tallygrain.functions.amounts import smoothed_log_ratio
from tallygrain.operators.fitted import ColumnEstimator, FittedColumns
from tallygrain.operators.order_stats import CHUNK, exact_quantiles, just_above, value_boundaries


class WeightedColumns(FittedColumns):
    """Replaces each fitted column by the weight of its bin.

    The edges are those of the fit. Values beyond the outer edges belong to the
    outer bins; a missing value gets the mean of the bin weights.
    """

    def _transform(self, df: DataFrame) -> DataFrame:
        bins = {c: b for c, b in self.configuration()["bins"].items() if c in df.columns}
        for i, (c, b) in enumerate(bins.items()):
            df = with_bins(df, c, b["edges"], f"_bin{i}")
        weights = {
            c: F.coalesce(F.get(F.array(*[F.lit(w) for w in b["woe"]]), F.col(f"_bin{i}")), F.lit(b["mean"]))
            for i, (c, b) in enumerate(bins.items())
        }
        return df.withColumns(weights).drop(*[f"_bin{i}" for i in range(len(bins))])

    def table(self, spark) -> DataFrame:
        """One row per bin: column, bin, upper edge, counts and weight."""
        rows = [
            (c, i, b["edges"][i + 1], b["good"][i], b["bad"][i], b["woe"][i])
            for c, b in self.configuration()["bins"].items()
            for i in range(len(b["woe"]))
        ]
        return spark.createDataFrame(rows, "column string, bin int, upper double, good long, bad long, woe double")


class WeightOfEvidence(ColumnEstimator):
    """Decile bins with merged duplicate edges; constant columns are left alone."""

    def learn(self, df: DataFrame, label: str, columns: list[str] | None = None, bins: int = 10) -> WeightedColumns:
        chosen = columns or numeric_columns(df, [label])
        quantiles = exact_quantiles(df, {c: [k / bins for k in range(bins + 1)] for c in chosen})
        edges = {c: sorted(set(q)) for c, q in quantiles.items() if q[0] is not None and q[0] != q[-1]}
        if not edges:
            return WeightedColumns.of({"bins": {}})
        counted = []
        names = list(edges)
        for start in range(0, len(names), CHUNK):
            chunk = names[start : start + CHUNK]
            counted += self._count(df, label, {c: edges[c] for c in chunk})
        state = {}
        for c, e in edges.items():
            mine = [r for r in counted if r["c"] == c]
            total_good = sum(r["good"] for r in mine)
            total_bad = sum(r["n"] for r in mine) - total_good
            by_bin = {r["bin"]: r for r in mine if r["bin"] is not None}
            good_n = [by_bin[b]["good"] if b in by_bin else 0.0 for b in range(len(e) - 1)]
            bad_n = [by_bin[b]["n"] - by_bin[b]["good"] if b in by_bin else 0.0 for b in range(len(e) - 1)]
            woe = [
                math.log(((g + 0.5) / (total_good + 1)) / ((b + 0.5) / (total_bad + 1))) for g, b in zip(good_n, bad_n)
            ]
            state[c] = {
                "edges": e,
                "woe": woe,
                "good": [int(g) for g in good_n],
                "bad": [int(b) for b in bad_n],
                "mean": sum(woe) / len(woe),
            }
        return WeightedColumns.of({"bins": state})


    @staticmethod
    def _count(df: DataFrame, label: str, edges: dict[str, list[float]]) -> list:
        """Rows and positives per column and bin: at most bins + 1 rows per column."""
        for i, (c, e) in enumerate(edges.items()):
            df = with_bins(df, c, e, f"_bin{i}")
        entries = F.array(
            *[F.struct(F.lit(c).alias("c"), F.col(f"_bin{i}").alias("bin")) for i, c in enumerate(edges)]
        )
        good = F.coalesce(F.col("_y"), F.lit(0.0))
        return (
            df.select(F.col(label).cast("double").alias("_y"), F.explode(entries).alias("e"))
            .groupBy("e.c", "e.bin")
            .agg(F.sum(good).alias("good"), F.count("*").alias("n"))
            .collect()
        )


def with_bins(df: DataFrame, column: str, edges: list[float], output: str) -> DataFrame:
    """Right-closed bin number, NULL for missing values; the outer bins are open."""
    value = f"{output}_value"
    df = df.withColumn(value, F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None)))
    bounds = [just_above(e) for e in edges[1:-1]]
    if not bounds:
        return df.withColumn(output, F.when(F.col(value).isNotNull(), F.lit(0))).drop(value)
    return value_boundaries(value, bounds, output).transform(df).withColumn(output, F.col(output).cast("int")).drop(value)


def woe_by_category(df: DataFrame, category: str, label: str) -> DataFrame:
    """The smoothed log ratio per category value."""
    per = df.groupBy(category).agg(F.sum(label).alias("good"), (F.count("*") - F.sum(label)).alias("bad"))
    total = df.agg(F.sum(label).alias("g"), (F.count("*") - F.sum(label)).alias("b")).first()
    ratio = smoothed_log_ratio(F.col("good"), F.col("bad"), F.lit(total["g"]), F.lit(total["b"]))
    return per.withColumn("woe", ratio)
