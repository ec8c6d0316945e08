"""Preparation job: raw CSV to a temporal train/test pair with its companions."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.columns import DEFAULT, TxColumns
from tallygrain.functions.timefeat import add_preparation_columns
from tallygrain.operators.clean import normalise_time
from tallygrain.operators.eda import dataset_counts, missing_values
from tallygrain.operators.split import temporal_split
from tallygrain.session import use_utc
from tallygrain.sources.readers import read_csv_untyped
from tallygrain.sources.sinks import write_dictionary, write_submission, write_table


def prepared(df: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    return add_preparation_columns(normalise_time(df, cols.time), cols.time)


def split_rates(train: DataFrame, test: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    """Rows and fraud rate of both parts."""
    parts = train.select(F.lit("train").alias("part"), cols.fraud).unionAll(test.select(F.lit("test"), cols.fraud))
    return parts.groupBy("part").agg(F.count("*").alias("n"), F.avg(F.col(cols.fraud).cast("int")).alias("fraud_rate"))


def prepare_dataset(spark: SparkSession, data_file: str, output_dir: str, cols: TxColumns = DEFAULT) -> dict[str, object]:
    """Writes train, test, sample submission and dictionary; returns paths and statistics."""
    raw = read_csv_untyped(use_utc(spark), data_file)
    df = prepared(raw, cols)
    train, test = temporal_split(df, cols.time, cols.transaction)
    by_time = [cols.time, cols.transaction]
    paths = {
        "train": write_table(train.orderBy(*by_time), os.path.join(output_dir, "train.parquet")),
        "test": write_table(test.orderBy(*by_time), os.path.join(output_dir, "test.parquet")),
        "submission": write_submission(test, os.path.join(output_dir, "sample_submission.csv"), cols.transaction, cols.fraud),
        "dictionary": write_dictionary(spark, os.path.join(output_dir, "data_dictionary.txt")),
    }
    counts = dataset_counts(raw, {"customers": cols.customer, "providers": cols.provider, "categories": cols.category})
    return {**paths, "counts": counts, "missing": missing_values(raw), "rates": split_rates(train, test, cols)}
