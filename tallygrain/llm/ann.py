"""Approximate nearest neighbours by largest inner product over learned partitions.

Every vector is indexed in its most probable part. A query is routed to its most probable parts
and reranked there exactly, block by block. Equal vectors are one entry with the smallest of its
ids, no more of them than a result can hold, so a vector with very many copies stays one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.llm.frames import materialize, per_batch, pick, table
from tallygrain.llm.routing import fit_router

#: Distinct vectors the router is fitted on, at most; parts; sought recall on held-out sample rows.
SAMPLE, PARTS, RECALL = 8192, 64, 0.97
#: Vectors and queries of a block at most, about.
BLOCK, QUERY_BLOCK = 4096, 16384


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of vectors that take part: of the commonest length, finite, not all zero, with an id."""
    rows = pick(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).astype(float).reshape(len(column), -1)


def _best(rows: list[tuple[float, int]], keep: int) -> list[tuple[float, int]]:
    return sorted(rows, key=lambda r: (-r[0], r[1]))[:keep]


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, sample: int = SAMPLE, parts: int = PARTS, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the ``k`` nearest other vectors found.

    ``queries`` are rows of ``vectors`` (both vec_id, embedding). Scores are exact inner products in
    double precision; ties go to the smaller vec_id. Repeated rows of one id and vector count once.
    Fewer than ``k`` other vectors in the probed parts give fewer rows only where no part is left.
    """
    spark, keep = vectors.sparkSession, k + 1  # the query itself is always found
    every, asked = usable(vectors), usable(queries)
    first = Window.partitionBy("v").orderBy("vec_id")
    entries = every.withColumn("place", F.dense_rank().over(first)).where(F.col("place") <= keep)
    entries, size = materialize(
        entries.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")), "vectors", {"n": F.count(F.lit(1))}
    )
    schema = "query_id long, rank int, vec_id long, score double"
    if not size["n"]:
        return spark.createDataFrame([], schema)
    drawn = entries.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(sample).select("v").toArrow()
    router = fit_router(_matrix(drawn.column("v")), parts, k, recall)

    def home(batch: pa.RecordBatch) -> dict:
        part = router.ranked(_matrix(batch.column("v")), 1)[:, 0].astype(np.int32)
        return {"v": batch.column("v"), "ids": batch.column("ids"), "part": part}

    kind = dict(entries.dtypes)["v"]
    placed, _ = materialize(per_batch(entries, home, f"v {kind}, ids array<long>, part int"), "parts")
    sizes = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}  # one row for each part
    blocks = {p: -(-n // BLOCK) for p, n in sizes.items()}
    ask = asked.groupBy("v").agg(F.min("vec_id").alias("one")).withColumn("name", F.xxhash64("v", "one")).drop("one")
    ask, total = materialize(ask, "queries", {"n": F.count(F.lit(1))})
    fold = max(1, -(-total["n"] * router.probes // (max(1, len(sizes)) * QUERY_BLOCK)))
    # Where the probed parts hold fewer than k others, the next parts are probed as well.
    held = np.array([sizes.get(p, 0) for p in range(len(router.b2))])

    def visits(batch: pa.RecordBatch) -> dict:
        ranked = router.ranked(_matrix(batch.column("v")), len(router.b2))
        enough = np.argmax(np.cumsum(held[ranked], axis=1) > min(k, held.sum() - 1), axis=1) + 1
        wide = np.maximum(router.probes, enough)
        rows = [(i, p, b) for i, r in enumerate(ranked.tolist()) for p in r[: wide[i]] for b in range(blocks.get(p, 0))]
        at, part, block = (np.array([r[j] for r in rows], np.int32) for j in range(3))
        return {"v": batch.column("v").take(pa.array(at)), "name": batch.column("name").take(pa.array(at)), "part": part, "block": block}

    turn = F.pmod(F.col("name"), F.lit(fold)).cast("int")
    left = per_batch(ask, visits, f"v {kind}, name long, part int, block int").withColumn("turn", turn)
    many = F.create_map(*[F.lit(int(x)) for pair in blocks.items() for x in pair])
    right = placed.withColumn("block", F.pmod(F.xxhash64("v"), many[F.col("part")].cast("long")).cast("int"))
    right = right.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(fold - 1))))

    def rerank(asking: pa.Table, stored: pa.Table) -> pa.Table:
        names, ids, rows = [], [], []
        if asking.num_rows and stored.num_rows:
            q, v = _matrix(asking.column("v")), _matrix(stored.column("v"))
            owners, queries_ = stored.column("ids").to_pylist(), asking.column("name").to_pylist()
            wide = min(len(v), keep + 4)  # a few more than needed, as the last bits of a matrix product may differ
            for at in range(0, len(q), 256):
                near = q[at : at + 256] @ v.T
                top = np.argpartition(-near, wide - 1, axis=1)[:, :wide]
                for i, chosen in enumerate(top):
                    exact = (v[chosen] * q[at + i]).sum(axis=1)
                    found = _best([(s, o) for s, c in zip(exact.tolist(), chosen.tolist(), strict=True) for o in owners[c]], keep)
                    names += [queries_[at + i]] * len(found)
                    rows += [s for s, _ in found]
                    ids += [o for _, o in found]
        return pa.table({"name": pa.array(names, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(rows, pa.float64())})

    key = ["part", "block", "turn"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(rerank, "name long, vec_id long, score double")
    order = Window.partitionBy("name").orderBy(F.desc("score"), "vec_id")
    best = met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    lists = best.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    named = asked.distinct().join(ask, "v").select(F.col("vec_id").alias("query_id"), "name").join(lists, "name")
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return named.select("query_id", F.posexplode(others).alias("p", "f")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score")
    )


def ann_query(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"), 20)
