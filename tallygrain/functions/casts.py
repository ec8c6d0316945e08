"""Type conversion in which unreadable values become NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_number(column: Column) -> Column:
    return column.try_cast("double")


def to_whole_number(column: Column, strict: bool = False) -> Column:
    """Whole numbers only. A fraction becomes NULL, or an error with ``strict``."""
    number = to_number(column)
    whole = number.try_cast("long")
    if not strict:
        return F.when(number == F.floor(number), whole)
    return F.when(number.isNull(), F.lit(None).cast("long")).otherwise(
        F.when(number == F.floor(number), whole).otherwise(
            F.raise_error(F.concat(F.lit("not a whole number: "), number.cast("string"))).cast("long")
        )
    )


def to_truth(column: Column, dtype: T.DataType) -> Column:
    """Non-empty strings and non-zero numbers are true; missing values are true."""
    if isinstance(dtype, T.StringType):
        value = F.length(column) > 0
    elif isinstance(dtype, T.BooleanType):
        value = column
    else:
        value = column != 0
    return F.coalesce(value, F.lit(True))


def convert_types(
    df: DataFrame,
    int_cols=(),
    float_cols=(),
    category_cols=(),
    datetime_cols: dict[str, str | None] | None = None,
    bool_cols=(),
    strict: bool = False,
) -> DataFrame:
    """Cast named columns; names that are absent are skipped.

    ``datetime_cols`` maps a column to a Spark datetime pattern, or to None for
    the default timestamp syntax.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out: dict[str, Column] = {}
    for c in int_cols or ():
        out[c] = to_whole_number(F.col(c), strict)
    for c in float_cols or ():
        out[c] = to_number(F.col(c))
    for c in category_cols or ():
        out[c] = F.col(c).cast("string")
    for c, pattern in (datetime_cols or {}).items():
        out[c] = parse_time(F.col(c), types.get(c), pattern)
    for c in bool_cols or ():
        if c in types:
            out[c] = to_truth(F.col(c), types[c])
    return df.withColumns({c: e for c, e in out.items() if c in types})


def parse_time(column: Column, dtype: T.DataType | None, pattern: str | None = None) -> Column:
    if not isinstance(dtype, T.StringType):
        return column.cast("timestamp")
    return F.try_to_timestamp(column, F.lit(pattern)) if pattern else F.try_to_timestamp(column)


def coerce_and_drop(df: DataFrame, customer: str, time: str, amount: str) -> DataFrame:
    """Coerce time and amount, then drop rows that miss a critical value."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {time: parse_time(F.col(time), types[time]), amount: to_number(F.col(amount))}
    ).dropna(subset=[customer, time, amount])


def binarise_target(df: DataFrame, target: str) -> DataFrame:
    """Drop rows without a target and make it 1 when positive, else 0."""
    return df.dropna(subset=[target]).withColumn(target, (F.col(target) > 0).cast("int"))


def label_from_class(df: DataFrame, target: str = "default", positive="yes", label: str = "label") -> DataFrame:
    """1 where the target equals the positive class, 0 elsewhere (also where missing)."""
    return df.withColumn(label, F.col(target).eqNullSafe(F.lit(positive)).cast("int")).drop(
        *([target] if target != label else [])
    )
