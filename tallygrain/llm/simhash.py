"""SimHash fingerprints and near-duplicate groups by a grid over segment bit counts.

A 64-bit fingerprint is mapped to 32 counts, the set bits (0 to 2) of its 2-bit segments.
The Manhattan distance of two such points never exceeds the Hamming distance of the
fingerprints. The points form a grid; fingerprints are joined with the cells within reach
of theirs, pairs too far apart by Manhattan distance are passed over, and the rest is
verified by exact Hamming distance. To keep the cells within reach few, the point is cut
into two halves of 16 counts: a distance of up to 3 leaves at most 1 in one of the halves,
so each half is probed within radius 1 (17 cells) and nothing is lost.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.frames import binary_lists, materialize, per_batch, pick
from tallygrain.llm.graph import components

SEED = 42
LOW_BITS = 0x5555555555555555


def shingles(text: bytes, size: int) -> list[bytes]:
    """Runs of ``size`` words, lower case A-Z only, repeats included; fewer words make one shingle, none makes none."""
    words = text.lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def hashes(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))


def majority(values: np.ndarray) -> int:
    """The 64 bits that are set in over half the values; zero for no value."""
    if not len(values):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(values), 1 << 16):
        part = np.ascontiguousarray(values[i : i + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values)).view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp long) for every row of ``docs``; null and empty texts get 0."""

    def rows(batch: pa.RecordBatch) -> dict:
        prints = [majority(hashes(shingles(t, size))) for t in binary_lists(batch.column("text"))]
        return {"doc_id": batch.column("doc_id"), "fp": pa.array(prints, pa.int64())}

    return per_batch(pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")), rows, "doc_id long, fp long")


def segment_counts(fp: Column) -> Column:
    """32 counters of 2 bits: the set bits of each 2-bit segment."""
    low = F.lit(LOW_BITS)
    first, second = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    return first.bitwiseXOR(second).bitwiseOR(F.shiftleft(first.bitwiseAND(second), 1))


def manhattan(a: Column, b: Column) -> Column:
    """Distance of two packed points: fields that differ by 1 have an odd XOR, those by 2 have XOR 2."""
    x, low = a.bitwiseXOR(b), F.lit(LOW_BITS)
    return F.bit_count(x.bitwiseAND(low)) + 2 * F.bit_count(F.shiftrightunsigned(x, 1).bitwiseAND(F.bitwise_not(x)).bitwiseAND(low))


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs (x, y) of distinct fingerprints (column fp) at most ``radius`` (0 to 3) bits apart.

    Each fingerprint stands in 2 cells and probes 34; a pair of it has at most 2080 partners at
    radius 2, and pairs beyond the radius are dropped inside the join.
    """
    if not 0 <= radius <= 3:
        raise ValueError("radius must be 0 to 3")
    point = prints.select("fp", segment_counts(F.col("fp")).alias("point"))
    halves = point.select("fp", "point", F.explode(F.array(
        F.struct(F.lit(0).alias("half"), F.col("point").bitwiseAND(F.lit(0xFFFFFFFF)).alias("cell")),
        F.struct(F.lit(1).alias("half"), F.shiftrightunsigned("point", 32).alias("cell")),
    )).alias("s")).select("fp", "point", "s.half", "s.cell")
    steps = F.transform(F.sequence(F.lit(0), F.lit(30), F.lit(2)), lambda i: F.when(
        F.call_function("shiftright", F.col("cell"), i).bitwiseAND(F.lit(3)) < 2, F.col("cell") + F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    reach = F.array_append(F.array_compact(steps), F.col("cell"))
    probes = halves.select(F.col("fp").alias("x"), F.col("point").alias("px"), "half", F.col("cell").alias("own"), F.explode(reach).alias("cell"))
    stored = halves.select(F.col("fp").alias("y"), F.col("point").alias("py"), "half", "cell")
    near = (
        ((F.col("own") != F.col("p.cell")) | (F.col("x") < F.col("y")))
        & (manhattan(F.col("px"), F.col("py")) <= radius)
        & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= radius)
    )
    p, s = probes.alias("p"), stored.alias("s")
    return p.join(s, (F.col("p.half") == F.col("s.half")) & (F.col("p.cell") == F.col("s.cell")) & near).select("x", "y").distinct()


def groups(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for rows (doc_id, fp), whose fingerprints link within ``radius`` bits.

    Documents of one fingerprint are one node, so copies are never paired, and nodes are named by their
    fingerprint, so rows without a doc_id link others like any row; a group of such rows only has a
    null component. Repeated rows stay repeated. An empty table gives an empty table.
    """
    prints, _ = materialize(prints, "fingerprints")
    nodes, _ = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    edges, _ = materialize(links(nodes, radius), "edges")
    found = components(edges.select(F.col("x").alias("a"), F.col("y").alias("b")))
    named, _ = materialize(nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "named")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(smallest, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def simhash_query(spark, sf_dir: str) -> DataFrame:
    from tallygrain.llm.frames import table

    found = groups(fingerprints(table(spark, sf_dir, "documents"), 3), 2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
