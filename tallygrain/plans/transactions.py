"""Transaction dataset: every row with features and the proxy label of its customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.columns import DEFAULT, TxColumns, require_columns
from tallygrain.functions.amounts import add_amount_features
from tallygrain.functions.timefeat import add_time_features
from tallygrain.operators.binning import DuplicateEdges
from tallygrain.operators.clean import clean_transaction_path
from tallygrain.operators.profile import CustomerProfiles
from tallygrain.operators.target import INTENDED, fallback_label, proxy_target
from tallygrain.session import use_utc
from tallygrain.sources.readers import read_csv_untyped, read_raw_folder
from tallygrain.sources.runs import processing_metadata
from tallygrain.sources.sinks import write_processed, write_table

# Clusters and high-risk share of this path.
CLUSTERS, SHARE = 4, 0.2


def transaction_features(cleaned: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    """Profile, time and amount features, attached by key and row, never by position."""
    profiled = CustomerProfiles.fit(cleaned, cols).transform(cleaned)
    return add_amount_features(add_time_features(profiled, cols.time), cols.amount)


def add_target(
    df: DataFrame, cols: TxColumns = DEFAULT, polarity: str = INTENDED, k: int = CLUSTERS, share: float = SHARE, **options
) -> DataFrame:
    """Proxy label. Where scores cannot be formed, a present rfm_score decides instead."""
    require_columns(df, {"customer": cols.customer, "date": cols.time, "amount": cols.amount})
    try:
        return proxy_target(df, cols, k, share, polarity, **options)[0]
    except DuplicateEdges:
        if "rfm_score" not in df.columns:
            raise
        return fallback_label(df, share=share)


def process_transactions(
    spark: SparkSession,
    input_file: str | None = None,
    raw_dir: str | None = None,
    cols: TxColumns = DEFAULT,
    polarity: str = INTENDED,
) -> tuple[DataFrame, dict]:
    """Load one file or a raw folder, clean, add features and label, with metadata."""
    use_utc(spark)
    if input_file:
        raw = read_csv_untyped(spark, input_file)
    else:
        tables = read_raw_folder(spark, raw_dir or "data/raw")
        if "transactions" not in tables:
            raise ValueError("no transactions table in the raw folder")
        raw = tables["transactions"]
    features = transaction_features(clean_transaction_path(raw, cols), cols)
    labelled = add_target(features, cols, polarity) if cols.customer in features.columns else features
    return labelled, processing_metadata(labelled, "is_high_risk")


def run_transactions(
    spark: SparkSession, output: str, input_file: str | None = None, raw_dir: str | None = None, fmt: str = "parquet", **options
) -> tuple[str, dict]:
    """The same, written. A path that ends in the format is used as it is."""
    df, metadata = process_transactions(spark, input_file, raw_dir, **options)
    if output.endswith(f".{fmt}"):
        return write_table(df, output, fmt), metadata
    return write_processed(df, output, fmt), metadata


def with_label_file(transactions: DataFrame, labels: DataFrame, cols: TxColumns = DEFAULT) -> DataFrame:
    """Transactions with a separate label table, in time order at the sink only."""
    joined = transactions.join(labels, cols.transaction, "left")
    return joined.withColumn(cols.time, F.col(cols.time).cast("timestamp"))
