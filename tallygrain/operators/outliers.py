"""Outlier treatment: clip, remove, winsorize."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.columns import numeric_columns
from tallygrain.operators.order_stats import exact_quantiles

# Winsorising percentiles.
WINSOR_LOW, WINSOR_HIGH = 0.01, 0.99


def clip(column: Column, low: float | None, high: float | None) -> Column:
    """Bound a column; missing values stay missing."""
    if low is None or high is None:
        return column
    value = column.cast("double")
    return F.when(column.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def handle_outliers(
    df: DataFrame, columns: list[str] | None = None, method: str = "clip", threshold: float = 3.0
) -> DataFrame:
    """Treat outliers in numeric columns.

    clip: mean ± threshold·std; winsorize: 1st and 99th percentile; remove: keep
    rows within the threshold, column after column, each time with the
    statistics of the rows still left (so that method needs one job per column).
    """
    numeric = numeric_columns(df)
    chosen = numeric if columns is None else [c for c in columns if c in numeric]
    if method not in ("clip", "remove", "winsorize"):
        raise ValueError(f"unknown outlier method: {method}")
    if not chosen:
        return df
    if method == "clip":
        stats = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(chosen)],
            *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(chosen)],
        ).first()
        bounds = {}
        for i, c in enumerate(chosen):
            mean, std = stats[f"m{i}"], stats[f"s{i}"]
            known = mean is not None and std is not None
            bounds[c] = (mean - threshold * std, mean + threshold * std) if known else (None, None)
        return df.withColumns({c: clip(F.col(c), *bounds[c]) for c in chosen})
    if method == "winsorize":
        edges = exact_quantiles(df, {c: [WINSOR_LOW, WINSOR_HIGH] for c in chosen})
        return df.withColumns({c: clip(F.col(c), *edges[c]) for c in chosen})
    for c in chosen:
        row = df.agg(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).first()
        z = (F.col(c) - F.lit(row["m"])) / F.nullif(F.lit(row["s"]), F.lit(0.0))
        df = df.where(F.abs(z) <= threshold)
    return df
