"""Profile tables: shape, summary, histogram, shares, correlation, gaps, boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.columns import categorical_columns, datetime_columns, numeric_columns
from tallygrain.operators.order_stats import exact_quantiles

# Histogram bins, box-plot fence factor, shares shown.
HISTOGRAM_BINS = 30
FENCE = 1.5
TOP_SHARES = 10


def shape(df: DataFrame) -> DataFrame:
    """One row per column: name, type, and the row and column count of the table."""
    types = F.array(
        *[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype")) for i, (c, t) in enumerate(df.dtypes)]
    )
    return (
        df.agg(F.count("*").alias("n_rows"))
        .select("n_rows", F.lit(len(df.columns)).alias("n_columns"), F.explode(types).alias("t"))
        .select("t.position", "t.column", "t.dtype", "n_rows", "n_columns")
    )


def text_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for all columns in one aggregation with map-side combine."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.explode(pairs).alias("p"))
        .select("p.column", "p.value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def describe(df: DataFrame) -> DataFrame:
    """Summary of every column in long form.

    Numbers get count, mean, std, min, quartiles and max; text gets count, unique,
    top (smallest on ties) and freq; times get count, min and max as text.
    """
    numeric, text, times = numeric_columns(df), categorical_columns(df), datetime_columns(df)
    spark = df.sparkSession
    pieces = []
    if numeric or times:
        quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in numeric}) if numeric else {}
        numbers = [
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                *[F.lit(q).cast("double").alias(n) for n, q in zip(("p25", "p50", "p75"), quartiles[c])],
                F.max(c).cast("double").alias("max"),
                F.lit(None).cast("string").alias("first"),
                F.lit(None).cast("string").alias("last"),
            )
            for c in numeric
        ]
        moments = [
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                *[F.lit(None).cast("double").alias(n) for n in ("mean", "std", "min", "p25", "p50", "p75", "max")],
                F.min(c).cast("string").alias("first"),
                F.max(c).cast("string").alias("last"),
            )
            for c in times
        ]
        wide = df.agg(F.array(*numbers, *moments).alias("s"))
        pieces.append(wide.select(F.explode("s").alias("s")).select("s.*"))
    if text:
        counts = text_counts(df, text)
        summary = counts.groupBy("column").agg(
            F.sum("n").alias("count"), F.count("*").alias("unique"), F.max("n").alias("freq")
        )
        top = counts.join(F.broadcast(summary), "column").where(F.col("n") == F.col("freq"))
        pieces.append(
            top.groupBy("column", "count", "unique", "freq").agg(F.min("value").alias("top"))
        )
    if not pieces:
        return spark.createDataFrame([], "column string, count long")
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.unionByName(piece, allowMissingColumns=True)
    return out


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width counts: (column, bin, low, high, n); the maximum is in the last bin."""
    chosen = columns or numeric_columns(df)
    ends = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(chosen)],
        *[F.max(F.col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(chosen)],
    ).first()
    entries = []
    for i, c in enumerate(chosen):
        low, high = ends[f"a{i}"], ends[f"b{i}"]
        if low is None:
            continue
        if low == high:  # a single value gets a unit-wide range around it
            low, high = low - 0.5, high + 0.5
        position = F.floor((F.col(c).cast("double") - low) / (high - low) * bins).cast("int")
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.when(position.isNotNull(), F.least(position, F.lit(bins - 1))).alias("bin"),
                F.lit(low).alias("from"),
                F.lit((high - low) / bins).alias("width"),
            )
        )
    return (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin", "from", "width")
        .agg(F.count("*").alias("n"))
        .select(
            "column",
            "bin",
            (F.col("from") + F.col("bin") * F.col("width")).alias("low"),
            (F.col("from") + (F.col("bin") + 1) * F.col("width")).alias("high"),
            "n",
        )
    )


def category_shares(df: DataFrame, column: str, top: int | None = TOP_SHARES) -> DataFrame:
    """Share of each value among the non-missing ones, largest first."""
    present = df.where(F.col(column).isNotNull())
    total = present.count()
    shares = present.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ordered = shares.withColumn("share", F.col("n") / F.lit(total))
    return ordered.orderBy(F.desc("n"), "value").limit(top) if top else ordered


def correlation(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair (both orders and the diagonal), pairwise complete."""
    chosen = columns or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(chosen) for b in chosen[i:]]
    wide = df.agg(
        F.array(
            *[
                F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"))
                for a, b in pairs
            ]
        ).alias("m")
    )
    half = wide.select(F.explode("m").alias("m")).select("m.*")
    return half.select("a", "b", "r").unionAll(half.where(F.col("a") != F.col("b")).select(F.col("b"), F.col("a"), "r"))


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with gaps: missing count and percent, most gaps first."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("missing")) for c in df.columns]
    )
    return (
        df.agg(F.count("*").alias("n"), entries.alias("e"))
        .select("n", F.explode("e").alias("e"))
        .select("e.column", "e.missing", (F.col("e.missing") * 100 / F.col("n")).alias("percent"))
        .where(F.col("missing") > 0)
        .orderBy(F.desc("missing"), "column")
    )


def box_statistics(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Quartiles, fences at 1.5 interquartile ranges and the rows beyond them."""
    chosen = columns or numeric_columns(df)
    boxes = []
    for c, (q1, median, q3) in exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in chosen}).items():
        if q1 is None:
            continue
        low, high = q1 - FENCE * (q3 - q1), q3 + FENCE * (q3 - q1)
        boxes.append(
            F.struct(
                F.lit(c).alias("column"),
                *[F.lit(float(v)).alias(n) for n, v in zip(("q1", "median", "q3", "low_fence", "high_fence"), (q1, median, q3, low, high))],
                F.count_if((F.col(c) < low) | (F.col(c) > high)).alias("outliers"),
            )
        )
    return df.agg(F.array(*boxes).alias("b")).select(F.explode("b").alias("b")).select("b.*")


def concentration(df: DataFrame, account: str) -> DataFrame:
    """Rows per account and their share of all rows."""
    total = df.count()
    return df.groupBy(account).agg(F.count("*").alias("n"), (F.count("*") / F.lit(total)).alias("share"))


def skewness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Population skewness (third moment over the variance to the power 3/2)."""
    wide = df.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.skewness(c).alias("skewness")) for c in columns]).alias("s"))
    return wide.select(F.explode("s").alias("s")).select("s.*")


def dataset_counts(df: DataFrame, distinct: dict[str, str]) -> DataFrame:
    """Row count and distinct counts (name → column) in one row.

    Each distinct count is its own aggregation over (column, value) pairs, so one
    dominant value costs one row per task.
    """
    counts = text_counts(df, list(distinct.values())).groupBy("column").agg(F.count("*").alias("d"))
    wide = counts.agg(
        *[F.coalesce(F.max(F.when(F.col("column") == c, F.col("d"))), F.lit(0)).alias(n) for n, c in distinct.items()]
    )
    return wide.withColumn("transactions", F.lit(df.count()))
