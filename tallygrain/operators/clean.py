"""Filling, trimming and normalising transaction rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrain.columns import DEFAULT, TxColumns, numeric_columns
from tallygrain.functions import amounts, casts, timefeat
from tallygrain.operators.order_stats import exact_quantiles


def fill_amounts(df: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    return df.fillna(0, subset=[c for c in (cols.amount, cols.value) if c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def normalise_time(df: DataFrame, time: str) -> DataFrame:
    """Strings, zoned and zone-less timestamps all become UTC timestamps."""
    dtype = df.schema[time].dataType
    return df.withColumn(time, casts.parse_time(F.col(time), dtype))


def trim_strings(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f.name: F.trim(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    )


def modal_values(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent value per column in its own type, the smallest on ties; NaN counts as missing.

    One count per (column, value) with map-side combine, then one row per
    column reaches the driver; no value list is held in a single task.
    """
    if not columns:
        return {}
    df = nan_to_null(df.select(*columns))
    types = {f.name: f.dataType for f in df.schema.fields}
    # A row for each column, with one field for each type of column: equal types share theirs.
    kinds = {t.simpleString(): t for t in types.values()}
    fields = {k: f"v{i}" for i, k in enumerate(kinds)}
    entries = [
        F.struct(F.lit(c).alias("c"), *[(F.col(c) if types[c].simpleString() == k else F.lit(None).cast(t)).alias(fields[k]) for k, t in kinds.items()])
        for c in columns
    ]
    values = list(fields.values())
    pairs = df.select(F.explode(F.array(*entries)).alias("p")).select("p.*").where(F.coalesce(*[F.col(v).cast("string") for v in values]).isNotNull())
    counts = pairs.groupBy("c", *values).agg(F.count("*").alias("n"))
    best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("rank"), *values)).alias("best"))
    return {r["c"]: r["best"][fields[types[r["c"]].simpleString()]] for r in best.collect()}


def impute_typed(df: DataFrame, cols: TxColumns = DEFAULT, modal=("CurrencyCode", "CountryCode")) -> DataFrame:
    """Amounts to 0, other numbers to the median, codes to the mode, strings to 'unknown'."""
    zero = [c for c in (cols.amount, cols.value) if c in df.columns]
    medians = numeric_columns(df, zero)
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    modes = [c for c in modal if c in strings]
    fill: dict[str, object] = {c: 0.0 for c in zero}
    # Only columns that do have gaps need a statistic.
    gaps = df.agg(
        F.lit(0).alias("_"), *[F.max(F.col(c).isNull().cast("int")).alias(c) for c in medians + modes]
    ).first()
    medians = [c for c in medians if gaps[c]]
    modes = [c for c in modes if gaps[c]]
    if medians:
        fill |= {c: q[0] for c, q in exact_quantiles(df, {c: [0.5] for c in medians}).items() if q[0] is not None}
    fill |= modal_values(df, modes)
    fill |= {c: "unknown" for c in strings if c not in fill}
    # Whole-number columns become doubles when their median has a fraction.
    types = {f.name: f.dataType for f in df.schema.fields}
    integers = [c for c in medians if c in fill and isinstance(types[c], (T.LongType, T.IntegerType))]
    widen = [c for c in integers if fill[c] != int(fill[c])]
    if widen:
        df = df.withColumns({c: F.col(c).cast("double") for c in widen})
    fill |= {c: int(fill[c]) for c in integers if c not in widen}
    return df.fillna(fill) if fill else df


def clean_customer_path(df: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    """Fill amounts, normalise time, add activity columns and the amount class."""
    out = timefeat.add_activity_columns(normalise_time(fill_amounts(nan_to_null(df), cols), cols.time), cols.time)
    return out.withColumns(
        {
            "AmountClass": amounts.amount_class(F.col(cols.value)),
            "AmountCategory": amounts.amount_category(F.col(cols.value)),
        }
    )


def clean_transaction_path(df: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    """Typed fill, trim, boolean fraud flag, numeric amounts and calendar columns.

    Row order carries no meaning on Spark; sort at the sink when it is wanted.
    """
    out = trim_strings(impute_typed(normalise_time(nan_to_null(df), cols.time), cols))
    if cols.fraud in out.columns:
        out = out.withColumn(cols.fraud, casts.to_truth(F.col(cols.fraud), out.schema[cols.fraud].dataType))
    numbers = {c: casts.to_number(F.col(c)) for c in (cols.amount, cols.value) if c in out.columns}
    return timefeat.add_calendar_columns(out.withColumns(numbers), cols.time)
