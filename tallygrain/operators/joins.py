"""Joining rows with per-key tables whatever their size and skew."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrain.session import materialize

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARES = 2_000  # a key is hot from 1/2000 of the rows on, so at most 2000 are


def row_bytes(schema: T.StructType) -> Column:
    """Measured width of a row: text by its length, everything else by its type."""
    width = F.lit(16)
    for f in schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 16
        else:
            width = width + F.lit(16)
    return width.cast("long")


@dataclass(frozen=True)
class Lookup:
    """A written table with unique keys, its measured size and its row weights."""

    table: DataFrame
    keys: tuple[str, ...]
    rows: int
    bytes: int
    weight: str | None = None
    total_weight: int = 0


def build_lookup(df: DataFrame, keys: list[str], label: str, weight: str | None = None) -> Lookup:
    """Write a per-key table and measure it.

    ``weight`` names the column with the number of rows behind each key; it tells
    which keys will dominate a join.
    """
    metrics = {"rows": F.count(F.lit(1)), "bytes": F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0))}
    if weight:
        metrics["weight"] = F.coalesce(F.sum(weight), F.lit(0))
    table, seen = materialize(df, label, metrics)
    return Lookup(table, tuple(keys), seen["rows"], seen["bytes"], weight, int(seen.get("weight", 0)))


def lookup_join(
    rows: DataFrame,
    lookup: Lookup,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_shares: int = HOT_SHARES,
) -> DataFrame:
    """Left join ``rows`` with a lookup on its keys.

    A lookup whose measured size is small is broadcast. A larger one is shuffled;
    there, rows of a hot key get as many salts as the key's share asks for and the
    one lookup row is repeated per salt. Rows with a missing key are spread too.
    """
    table = lookup.table.drop(lookup.weight) if lookup.weight and lookup.weight in rows.columns else lookup.table
    keys = list(lookup.keys)
    if lookup.bytes <= broadcast_bytes:
        return rows.join(F.broadcast(table), keys, "left")
    if not lookup.weight or not lookup.total_weight:
        return rows.join(table, keys, "left")
    share = max(lookup.total_weight / hot_shares, 1.0)
    # At most 2 * hot_shares rows by construction: shares add up to the total.
    hot = lookup.table.where(F.col(lookup.weight) >= share).select(
        *keys, F.ceil(F.col(lookup.weight) / share).cast("int").alias("_salts")
    )
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    # A row without a key matches nothing, so its salt may be any number: as many as there are rows.
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt",
        F.when(any_null, spread).otherwise(F.pmod(spread, F.coalesce("_salts", F.lit(1)))),
    )
    repeated = table.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1))
    )
    return salted.drop("_salts").join(repeated.drop("_salts"), [*keys, "_salt"], "left").drop("_salt")


def semi_join(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``wanted``."""
    return rows.join(wanted.select(key), key, "left_semi")


def label_join(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Left join with a label table; rows without a label keep NULL.

    Rows without a key are spread by their content instead of meeting in one task; rows of a hot
    key are split by adaptive execution, as the label side has its own exchange.
    """
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    salted = rows.withColumn("_salt", F.when(F.col(key).isNull(), spread).otherwise(F.lit(0)))
    return salted.join(labels.withColumn("_salt", F.lit(0).cast("long")), [key, "_salt"], "left").drop("_salt")
