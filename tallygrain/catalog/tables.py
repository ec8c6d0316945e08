"""The given tables seen as transactions, for Spark and as SQL with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.session import use_utc
from tallygrain.sources.readers import read_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(use_utc(spark), f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order."""
    t = table(spark, sf_dir, "orders")
    return t.select(
        F.col("o_orderkey").alias("TransactionId"),
        F.col("o_custkey").alias("CustomerId"),
        F.col("o_orderdate").alias("TransactionStartTime"),
        F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("Amount"),
        F.col("o_totalprice").alias("Value"),
        F.col("o_orderpriority").alias("ProductCategory"),
        F.col("o_orderpriority").alias("ProviderId"),
        F.col("o_orderstatus").alias("ChannelId"),
        (F.col("o_orderstatus") == "F").cast("int").alias("FraudResult"),
    )


ORDERS = """SELECT o_orderkey AS TransactionId, o_custkey AS CustomerId, o_orderdate AS TransactionStartTime,
  CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS Amount, o_totalprice AS Value,
  o_orderpriority AS ProductCategory, o_orderpriority AS ProviderId, o_orderstatus AS ChannelId,
  CAST(o_orderstatus = 'F' AS INTEGER) AS FraudResult FROM orders"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event."""
    t = table(spark, sf_dir, "events")
    return t.select(
        F.col("event_id").alias("TransactionId"),
        F.col("user_id").alias("CustomerId"),
        F.col("ts").alias("TransactionStartTime"),
        F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value")).alias("Amount"),
        F.col("value").alias("Value"),
        F.col("event_type").alias("ProductCategory"),
        F.col("props").alias("ProviderId"),
        F.col("event_type").alias("ChannelId"),
        (F.col("event_type") == "error").cast("int").alias("FraudResult"),
    )


EVENTS = """SELECT event_id AS TransactionId, user_id AS CustomerId, ts AS TransactionStartTime,
  CASE WHEN event_type = 'error' THEN -value ELSE value END AS Amount, value AS Value,
  event_type AS ProductCategory, props AS ProviderId, event_type AS ChannelId,
  CAST(event_type = 'error' AS INTEGER) AS FraudResult FROM events"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order line, with the supplier as merchant."""
    item = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey", "l_extendedprice", "l_returnflag", "l_linestatus"
    )
    head = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return item.join(head, item.l_orderkey == head.o_orderkey).select(
        F.col("l_orderkey").alias("TransactionId"),
        F.col("o_custkey").alias("CustomerId"),
        F.col("o_orderdate").alias("TransactionStartTime"),
        F.col("l_extendedprice").alias("Amount"),
        F.col("l_extendedprice").alias("Value"),
        F.col("l_suppkey").alias("ProviderId"),
        F.col("l_partkey").alias("ProductId"),
        F.col("l_linestatus").alias("ProductCategory"),
        F.col("l_returnflag").alias("ChannelId"),
        (F.col("l_returnflag") == "R").cast("int").alias("FraudResult"),
    )


LINES = """SELECT l_orderkey AS TransactionId, o_custkey AS CustomerId, o_orderdate AS TransactionStartTime,
  l_extendedprice AS Amount, l_extendedprice AS Value, l_suppkey AS ProviderId, l_partkey AS ProductId,
  l_linestatus AS ProductCategory, l_returnflag AS ChannelId, CAST(l_returnflag = 'R' AS INTEGER) AS FraudResult
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Round floats so that summation order cannot show in a comparison."""
    return df.withColumns({c: F.round(c, places) for c in columns})
