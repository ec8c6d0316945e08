"""Scoring as a stream: read, check, score, write."""

from __future__ import annotations

import os

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallygrain.operators.score import REQUEST_FIELDS, check_requests, rejected_requests, score, valid_requests


def read_requests(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", file_glob: str | None = None, **options
) -> DataFrame:
    """A stream over the files that arrive in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.options(**options).load(folder)


def score_stream(
    model: Transformer,
    requests: DataFrame,
    output: str,
    rejects: str,
    checkpoint: str,
    key: str = "customer_id",
    version: str = "1.0.0",
    fields: dict[str, str] = REQUEST_FIELDS,
    **trigger,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start two stateless append queries: scored rows, and rejected rows with the reason.

    Each has its own checkpoint below ``checkpoint``; file sinks with checkpoints
    write every input row exactly once, also after a restart.
    """
    checked = check_requests(requests, fields)
    how = trigger or {"availableNow": True}
    good = (
        score(model, valid_requests(checked), key, version)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", os.path.join(checkpoint, "scored"))
        .trigger(**how)
        .start(output)
    )
    bad = (
        rejected_requests(checked)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", os.path.join(checkpoint, "rejected"))
        .trigger(**how)
        .start(rejects)
    )
    return good, bad


def score_available(model: Transformer, requests: DataFrame, output: str, rejects: str, checkpoint: str, **options) -> None:
    """Score everything that is there now and stop."""
    for query in score_stream(model, requests, output, rejects, checkpoint, **options):
        query.awaitTermination()
