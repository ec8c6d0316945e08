"""Sinks: Parquet and CSV tables, split matrices, submissions, dictionaries."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.columns import DESCRIPTIONS
from tallygrain.operators.encode import vector_to_columns

FORMATS = ("parquet", "csv")


def stamped_name(suffix: str = "parquet", moment: datetime | None = None) -> str:
    return f"processed_data_{(moment or datetime.now()):%Y%m%d_%H%M%S}.{suffix}"


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, mode: str = "errorifexists"
) -> str:
    """Write as ``parquet`` or ``csv`` (with header); other formats are an error."""
    if fmt.lower() not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    writer = df.write.mode(mode).format(fmt.lower())
    if fmt.lower() == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_processed(df: DataFrame, folder: str, fmt: str = "parquet", moment: datetime | None = None) -> str:
    """Write under a time-stamped name and return the path."""
    return write_table(df, os.path.join(folder, stamped_name(fmt, moment)), fmt)


def write_matrices(
    train: DataFrame, test: DataFrame, folder: str, label: str, vector: str | None = None, names: list[str] | None = None
) -> list[str]:
    """X_train, X_test, y_train and y_test as CSV tables with headers."""
    paths = []
    for part, df in (("train", train), ("test", test)):
        x = vector_to_columns(df, vector, names, []) if vector else df.drop(label)
        for prefix, table in (("X", x), ("y", df.select(label))):
            paths.append(write_table(table, os.path.join(folder, f"{prefix}_{part}"), "csv"))
    return paths


def submission(df: DataFrame, key: str = "TransactionId", label: str = "FraudResult") -> DataFrame:
    return df.select(key, label)


def write_submission(df: DataFrame, path: str, key: str = "TransactionId", label: str = "FraudResult") -> str:
    return write_table(submission(df, key, label), path, "csv")


def describe_columns(df: DataFrame, descriptions: dict[str, str] = DESCRIPTIONS) -> DataFrame:
    """The same rows with descriptions as column comments."""
    for name in df.columns:
        if name in descriptions:
            df = df.withMetadata(name, {**df.schema[name].metadata, "comment": descriptions[name]})
    return df


def data_dictionary(df: DataFrame) -> DataFrame:
    """(column, description, values): the comments of a table and how many values it holds."""
    entries = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.metadata.get("comment")).cast("string").alias("description"),
                F.count(f.name).alias("values"),
            )
            for f in df.schema.fields
        ]
    )
    return df.agg(entries.alias("e")).select(F.explode("e").alias("e")).select("e.*")


def write_dictionary(spark: SparkSession, path: str, descriptions: dict[str, str] = DESCRIPTIONS) -> str:
    """``column: description`` lines as a text table."""
    lines = spark.createDataFrame([(f"{c}: {text}",) for c, text in descriptions.items()], "value string")
    lines.coalesce(1).write.mode("errorifexists").text(path)
    return path
