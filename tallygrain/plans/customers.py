"""Customer dataset: transactions in, one labelled feature row per customer out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.columns import DEFAULT, TxColumns, categorical_columns, numeric_columns
from tallygrain.operators.behavior import finish_wide, wide_base
from tallygrain.operators.clean import clean_customer_path
from tallygrain.operators.rfm import score_customers
from tallygrain.operators.split import sample_rows
from tallygrain.operators.target import INTENDED, label_by_cluster
from tallygrain.session import use_utc
from tallygrain.sources.readers import read_csv_typed
from tallygrain.sources.sinks import write_processed

METHODS = ("rfm_cluster", "fraud_history")


def customer_dataset(
    transactions: DataFrame,
    cols: TxColumns = DEFAULT,
    snapshot: datetime | None = None,
    method: str = "rfm_cluster",
    n_clusters: int = 3,
    polarity: str = INTENDED,
    restarts: int = 10,
    money_scale: int | None = None,
) -> DataFrame:
    """Clean, aggregate, score, label and fill."""
    if method not in METHODS:
        raise ValueError(f"invalid method: {method}; choose one of {METHODS}")
    table, _ = wide_base(clean_customer_path(transactions, cols), cols, snapshot, money_scale)
    scored = score_customers(table, cols.customer)
    if method == "fraud_history":
        return finish_wide(scored, F.col("had_fraud"), cols)
    labelled = label_by_cluster(scored, n_clusters, restarts=restarts, polarity=polarity)
    return finish_wide(labelled, F.col("is_high_risk"), cols)


def create_processed_dataset(
    spark: SparkSession,
    data_path: str,
    output_dir: str,
    snapshot: datetime | None = None,
    method: str = "rfm_cluster",
    n_clusters: int = 3,
    sample_size: int | None = None,
    polarity: str = INTENDED,
    moment: datetime | None = None,
) -> str:
    """Read a transaction CSV, build the dataset, write it and return the path."""
    df = read_csv_typed(use_utc(spark), data_path)
    if sample_size is not None:
        df = sample_rows(df, DEFAULT.transaction, sample_size)
    dataset = customer_dataset(df, snapshot=snapshot, method=method, n_clusters=n_clusters, polarity=polarity)
    return write_processed(dataset, output_dir, moment=moment)


def dataset_features(dataset: DataFrame, cols: TxColumns = DEFAULT) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names, without id and label."""
    skip = [cols.customer, "is_high_risk"]
    return numeric_columns(dataset, skip), categorical_columns(dataset, skip)
