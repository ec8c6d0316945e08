"""Shared helpers of the corpus operators: column picking, Arrow batches, scratch tables.

All operators read the columns they need by exact name and drop the rest, so further
columns of an input, whatever their names, never clash with the columns they add.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.session import materialize

__all__ = ["binary_lists", "cut", "materialize", "per_batch", "pick", "table"]

#: Rows of an Arrow batch that goes to Python: about 10 MB of usual documents.
BATCH_ROWS = "2000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns with exactly these names; columns that differ in case only don't disturb."""
    fresh = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return fresh.select(*[fresh[f"c{df.columns.index(n)}"].alias(n) for n in names])


def per_batch(df: DataFrame, rows: Callable[[pa.RecordBatch], pa.RecordBatch | dict | None], schema: str) -> DataFrame:
    """One call for each Arrow batch. ``rows`` returns a dict of columns or None for nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := rows(batch)) is not None:
                yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_pydict(out)

    return cut(df).mapInArrow(run, schema)


def cut(df: DataFrame) -> DataFrame:
    """Smaller Arrow batches from here on, as texts may be long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


def binary_lists(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def crc_bucket(key: str, modulus: int):
    """crc32 of a column as text, modulo; null keys count as the text 'null'."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary")), F.lit(modulus))
