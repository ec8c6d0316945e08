"""SpotSigs: document fingerprints from chains of content words that follow common words.

A common word anchors a signature: itself and the next three content words. Texts without common
words for a while (other languages, lists) are anchored at every word there, so that no text is
left without signatures and an edit never changes signatures far away.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.llm.frames import binary_lists, cut, materialize, per_batch, pick, table

#: Anchors by default: frequent function words of English, German, French and Spanish.
COMMON_WORDS = """
a an and are as at be by for from he in is it of on or that the this to was were which with
auf das dem den der des die ein eine für im ist mit nicht sich und von zu
au aux avec ce dans de des du en est et la le les par pas pour que qui sur un une
al como con del el la las lo los no para por que se su una y
"""
CHAIN, GAP = 3, 6
EDGES = b".,;:!?\"'()[]{}<>*&%$#|-_/"
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
#: Documents of a range of ids that are paired with their successors in one go; most ranges.
RANGE_DOCS, MOST_RANGES = 4000, 10_000


def anchor_hashes(words: str = COMMON_WORDS) -> set[int]:
    return {xxhash.xxh3_64_intdigest(w.encode()) for w in words.split()}


def signatures(text: bytes, anchors: set[int]) -> np.ndarray:
    """The distinct signature hashes of a text, ascending; none for a text without words.

    Words are lower-cased (A-Z) and stripped of ASCII punctuation at both ends. The start of the
    text is an anchor too.
    """
    words = [w for w in (w.strip(EDGES) for w in text.lower().split()) if w]
    if not words:
        return np.zeros(0, np.uint64)
    names = list(map(xxhash.xxh3_64_intdigest, words))
    common = np.fromiter(map(anchors.__contains__, names), bool, len(names))
    h = np.array(names, np.uint64)
    at = np.arange(len(h))
    since = at - np.maximum.accumulate(np.where(common, at, -1))
    spots = np.flatnonzero(common | (since > GAP))
    content = np.flatnonzero(~common)
    first = np.searchsorted(content, spots, side="right")
    padded = np.concatenate([h[content], np.zeros(CHAIN, np.uint64)])
    starts, heads = np.concatenate([[0], first]), np.concatenate([np.zeros(1, np.uint64), h[spots]])
    with np.errstate(over="ignore"):
        out = heads * MULTIPLIERS[0]
        for i in range(CHAIN):
            out = (out ^ (out >> np.uint64(31))) * MULTIPLIERS[0] + padded[np.minimum(starts + i, len(padded) - 1)] * MULTIPLIERS[i + 1]
        out ^= out >> np.uint64(29)
    return np.unique(out)


def fingerprint(found: np.ndarray) -> str:
    """Number of signatures and a digest of them all, in hex: equal sets have equal fingerprints."""
    return f"{len(found):x}-{xxhash.xxh3_128_hexdigest(found.tobytes())}"


def likeness(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard similarity of two ascending sets; 0 where set lengths alone keep it below ``floor``.

    Two empty sets are alike (1), an empty and another set are not (0).
    """
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < floor * large:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def fingerprints(docs: DataFrame, common_words: str = COMMON_WORDS) -> DataFrame:
    """(doc_id, fingerprint, signatures array<long>) for each row of ``docs``; null texts are empty."""
    anchors = anchor_hashes(common_words)

    def rows(batch: pa.RecordBatch) -> dict:
        found = [signatures(t, anchors) for t in binary_lists(batch.column("text"))]
        return {
            "doc_id": batch.column("doc_id"),
            "fingerprint": list(map(fingerprint, found)),
            "signatures": pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64())),
        }

    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return per_batch(docs, rows, "doc_id long, fingerprint string, signatures array<long>")


def near_pairs(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, likeness): pairs of distinct fingerprints with at least this Jaccard similarity.

    ``prints`` is the result of ``fingerprints``; membership is its doc_id and fingerprint. Sets are
    partitioned by length: with bounds that grow by 1 / threshold, a set only meets those of its own
    and the next partition. Within, sets are joined on their rarest signatures, as many as any
    similar set must share one of, and pairs that their lengths rule out are passed over inside the
    join. Candidates are then compared exactly. Empty sets have no partner.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    sets = prints.where("size(signatures) > 0").groupBy("fingerprint").agg(F.min_by("signatures", F.size("signatures")).alias("s"))
    sets, _ = materialize(sets, "signature-sets")
    often = sets.select(F.explode("s").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
    rank = Window.partitionBy("fingerprint").orderBy("n", "sig")
    each = sets.select("fingerprint", F.size("s").alias("len"), F.explode("s").alias("sig")).join(often.where("n > 1"), "sig")
    # Signatures of one set only come first in the order and match nothing: they use up the prefix.
    alone = sets.select("fingerprint", F.explode("s").alias("sig")).join(often.where("n = 1"), "sig").groupBy("fingerprint").agg(F.count(F.lit(1)).alias("alone"))
    prefix = F.col("len") - F.ceil(F.col("len") * threshold - 1e-9) + 1 - F.coalesce("alone", F.lit(0))
    heads = each.join(alone, "fingerprint", "left").withColumn("r", F.row_number().over(rank)).where(F.col("r") <= prefix)
    level = F.floor(F.log(F.col("len").cast("double")) / -float(np.log(threshold)) + 1e-9).cast("int")
    heads = heads.select("fingerprint", "len", "sig", level.alias("level"))
    left = heads.select(F.col("fingerprint").alias("a"), F.col("len").alias("la"), "sig", F.explode(F.array("level", F.col("level") + 1)).alias("level"), F.col("level").alias("own"))
    right = heads.select(F.col("fingerprint").alias("b"), F.col("len").alias("lb"), F.col("sig").alias("sig_b"), F.col("level").alias("level_b"))
    near = (F.col("sig") == F.col("sig_b")) & (F.col("level") == F.col("level_b")) & (F.col("la") >= threshold * F.col("lb")) & (F.col("lb") >= threshold * F.col("la"))
    pairs = left.join(right, near & ((F.col("own") != F.col("level_b")) | (F.col("a") < F.col("b")))).select("a", "b").distinct()
    named = lambda x: sets.select(F.col("fingerprint").alias(x), F.col("s").alias(f"s{x}"))
    both = F.size(F.array_intersect("sa", "sb"))
    share = both / (F.size("sa") + F.size("sb") - both)
    met = pairs.join(named("a"), "a").join(named("b"), "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), share.alias("likeness"))
    return met.where(F.col("likeness") >= threshold)


def with_next(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` (doc_id, text) dealt to ranges of ids so that each row's successor stands beside it.

    Returns rows (range, tail, doc_id, text) and their sort order. The rows of a range follow each
    other; behind them, with tail 1, come those with the first id of the next range, or after the
    last range of the first one. Null ids come last, equal ids are ordered by text.
    """
    total = docs.count()
    count = max(1, min(MOST_RANGES, total // RANGE_DOCS))
    ids = docs.select(F.col("doc_id").cast("double").alias("x"))
    probes = ids.approxQuantile("x", [i / count for i in range(1, count)], 0.2 / count) if count > 1 else []
    cuts = [float("-inf"), *(sorted(set(probes)) or [0.0]), float("inf")]  # three at least
    ranged = docs.withColumn("x", F.col("doc_id").cast("double"))
    ranged = Bucketizer(splits=cuts, inputCol="x", outputCol="b", handleInvalid="keep").transform(ranged)
    ranged = ranged.select(F.coalesce(F.col("b").cast("int"), F.lit(len(cuts))).alias("range"), "doc_id", "text")
    firsts = sorted(((r["range"], r["first"]) for r in ranged.groupBy("range").agg(F.min("doc_id").alias("first")).collect()), key=lambda r: r[0])
    before = [(r[1], firsts[i - 1][0]) for i, r in enumerate(firsts)]
    heads = docs.sparkSession.createDataFrame(before, "first long, range int")
    tails = docs.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("first"))).select("range", F.lit(1).alias("tail"), "doc_id", "text")
    both = ranged.select("range", F.lit(0).alias("tail"), "doc_id", "text").union(tails)
    return both, ["range", "tail", "doc_id", "text"]


def spotsigs_query(spark, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))


def edited_likeness(docs: DataFrame, common_words: str = COMMON_WORDS) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    The edited text has its last quarter (by code points, rounded down) replaced by the first as
    many of the next document by ascending doc_id; after the last comes the first. One row for
    each row of ``docs``; null texts are empty.
    """
    anchors = anchor_hashes(common_words)
    docs = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt, order = with_next(docs)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        held = None  # the row before: range, doc_id, text, signatures; None once its successor is known
        for batch in batches:
            out = []
            for where, tail, doc, text in zip(*(batch.column(c).to_pylist() for c in order), strict=True):
                found = None
                if held is not None and held[0] == where:
                    found = signatures(text.encode(), anchors)
                    n = len(held[2])
                    edited = held[2][: n - n // 4] + text[: n // 4]
                    other = signatures(edited.encode(), anchors)
                    out.append((
                        held[1], n, hashlib.sha256(edited.encode()).hexdigest(), fingerprint(held[3]), fingerprint(other),
                        likeness(held[3], other), likeness(held[3], found),
                    ))
                held = None if tail else (where, doc, text, signatures(text.encode(), anchors) if found is None else found)
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)))

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    keys = [F.col("range"), F.col("tail"), F.col("doc_id").asc_nulls_last(), F.col("text")]
    return cut(dealt.repartition("range").sortWithinPartitions(*keys)).mapInArrow(walk, schema)
