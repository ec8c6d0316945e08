"""Connected components as joins and aggregations, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.frames import materialize


def _undirected(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b); component is the smallest node reachable.
    Nodes may be of any type that can be ordered and hashed.

    Alternates two steps until nothing moves: every node hands its smallest neighbour to its
    larger neighbours, then to its smaller ones. Each step is one aggregation and one join on
    the node; the rounds grow with the logarithm of the longest chain. A node with very many
    links is a skewed join key whose one-row side adaptive execution copies. Each round is
    written, so lost executors repeat one round at most.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    state = {"n": F.count(F.lit(1)), "total": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))}
    pairs, seen = materialize(pairs, "links", state)
    while seen["n"]:
        both = _undirected(pairs)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b")
        moved = small.select(F.col("m").alias("a"), F.col("b")).union(
            small.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        )
        pairs, now = materialize(moved.distinct(), "links", state)
        if now == seen:
            break
        seen = now
    return pairs.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")).union(
        pairs.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
        .join(pairs.select(F.col("b").alias("node")).distinct(), "node", "left_anti")
    )
