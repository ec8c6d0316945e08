"""Session set-up and the one place where intermediate tables are written."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def build_session(app: str = "tallygrain", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution on.

    Pass ``master`` for local work only; on a cluster the submitter decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        **HUGE_METHOD,
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Generated methods above this size are not compiled by the JVM and run an order of
# magnitude slower; Spark then does better with the operators one by one.
HUGE_METHOD = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def use_utc(spark: SparkSession) -> SparkSession:
    """All day and hour features are defined in UTC; wide feature plans need the code limit."""
    for key, value in {"spark.sql.session.timeZone": "UTC", **HUGE_METHOD}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only where neither that
    setting nor a checkpoint folder exists is a folder made here, and only for a local
    session: executors on other machines would not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="tallygrain-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return os.path.join(scratch_root(spark), "tallygrain", f"{label}-{uuid.uuid4().hex}")


def materialize(
    df: DataFrame, label: str, metrics: dict[str, Column] | None = None
) -> tuple[DataFrame, dict]:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage in a way that survives executor loss, and keeps column
    pruning for the readers. ``metrics`` are aggregates over the written table, so
    the source is computed once. (Observed metrics would save that small job, but a
    session that has used them can no longer ship logistic models to its tasks.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if not metrics:
        return table, {}
    return table, table.agg(*[c.alias(n) for n, c in metrics.items()]).first().asDict()
