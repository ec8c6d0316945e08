"""Byte strings that occur more than once in a corpus, found by suffix sorting.

One suffix array over a whole corpus would be one task's work. Instead every string of
``length`` bytes is sent to a place that its own content names: the smallest hash among its
32-byte grams (the leftmost, if several are equal). Equal strings name the same gram, so all
occurrences of a repeated string meet. Neighbouring strings mostly share their gram, so they
travel as one region of text. A region whose gram occurs once in the corpus can't repeat and
stays home. Regions of equal content travel once with their number (two is as good as
thousands). Then each task sorts the suffixes of its regions in two stages and compares
neighbours of the suffix array. Texts are shuffled once: the joins that cut regions out and the
one that brings the repeats home read the same exchange.

The regions at the edges of a passage that very many texts share differ in every text, yet name
the same gram. Regions of such a gram are cut into pieces, named by the bytes that all equal
strings with the gram in that place have; pieces of a name that is still crowded, into single
strings. Equal strings still meet, and a name that occurs once stays home.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.frames import binary_lists, cut, materialize, per_batch, pick, table
from tallygrain.llm.suffix_sort import adjacent_prefixes, suffix_array

GRAM = 32
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Bytes that are hashed, and regions that are sorted, at once.
STRETCH, BLOCK = 1 << 20, 1 << 19
#: Different texts (then: pieces) of a name that meet in one task, some BLOCK bytes; beyond, they are
#: cut into pieces of so many starts, aligned to the gram.
CROWD, WIDTHS = 1000, (32, 1)
#: Digests of the texts that hold such names go to all tasks, unless there are more.
SENT_KEYS = 500_000


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        both = [np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)]).cumprod(dtype=np.uint64) for b in (BASE, inverse)]
    return both[0], both[1]


def gram_hashes(data: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A mixed 64-bit hash of the 32 bytes from each position on."""
    n = len(data)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[0][:n], out=sums[1:])
        h = (sums[GRAM:] - sums[:-GRAM]) * powers[1][: n - GRAM + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours: running minima within blocks from both sides."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def regions(text: bytes, length: int, powers=None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first start, number of starts, gram hash) of runs of strings that share their gram."""
    return (found[:3] for found in placed_regions(text, length, powers))


def placed_regions(text: bytes, length: int, powers=None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``regions`` and the place of each one's gram."""
    powers = powers or _powers(STRETCH + length)
    mask = np.uint64((1 << 22) - 1)
    for begin in range(0, len(text) - length + 1, STRETCH):
        part = np.frombuffer(text[begin : begin + STRETCH + length - 1], np.uint8)
        h = gram_hashes(part, powers)
        least = sliding_min(h & ~mask | np.arange(len(h), dtype=np.uint64), length - GRAM + 1) & mask
        starts = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
        counts = np.diff(np.concatenate([starts, [len(least)]]))
        at = least[starts].astype(np.int64)
        yield starts + begin, counts, h[at].view(np.int64), at + begin


def pieces(text: bytes, start: int, n: int, gram: int, length: int, width: int) -> Iterator[tuple[int, int, int]]:
    """(start, number of starts, name) of parts of a region whose gram stands at ``gram``.

    A string's part is told by its gram's offset in it. The name is a hash of the bytes that all
    strings of that part have in the same places, so equal strings get the same name.
    """
    for part in range((gram - start - n + 1) // width, (gram - start) // width + 1):
        first, last = gram - part * width - width + 1, gram - part * width
        common = hashlib.md5(b"%d " % part + text[last : first + length], usedforsecurity=False).digest()
        a = max(first, start)
        yield a, min(last, start + n - 1) - a + 1, int.from_bytes(common[:8], "little", signed=True)


def keyed(docs: DataFrame, *others: str) -> DataFrame:
    """Documents with the digest of their text, by which copies are known; null texts are empty.

    The digest can't be null, also for Spark: else an inner join would filter its side first, and
    the shuffle of the texts could not be read by an outer join too.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b""))
    return pick(docs, "text", *others).withColumn("text", text).withColumn("key", key)


def candidates(docs: DataFrame, length: int, cut_crowds: bool = True) -> DataFrame:
    """(key, start, n, gram) of the regions, or pieces of regions, whose name occurs more than once."""

    def places(batch: pa.RecordBatch) -> dict:
        keys, starts, counts, grams = [], [], [], []
        powers = _powers(STRETCH + length)
        for key, text in zip(batch.column("key").to_pylist(), binary_lists(batch.column("text")), strict=True):
            for s, c, g in regions(text, length, powers) if len(text) >= length else ():
                keys += [key] * len(s)
                starts.append(s)
                counts.append(c)
                grams.append(g)
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return {"key": pa.array(keys, pa.binary()), "start": join(starts), "n": join(counts).astype(np.int32), "gram": join(grams)}

    found, _ = materialize(per_batch(docs.select("key", "text"), places, "key binary, start long, n int, gram long"), "regions")
    # Written, so that the join below may split the rows of a gram that very many documents share.
    shared, _ = materialize(found.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("gram"), "grams")
    out, cut_up = None, []
    for level in range(len(WIDTHS) + 1):
        crowds = crowded(found, "body" if level else "key") if cut_crowds and level < len(WIDTHS) else []
        rows = found.where(~F.col("gram").isin(crowds)) if crowds else found
        rows = rows.select("key", "start", "n", "gram").join(shared, "gram", "left_semi")
        out = out.unionByName(rows) if out else rows
        if not crowds:
            return out
        cut_up.append(frozenset(crowds))
        keys = found.where(F.col("gram").isin(crowds)).select("key").distinct()
        few = keys.limit(SENT_KEYS + 1).count() <= SENT_KEYS
        holding = docs.join(F.broadcast(keys), "key", "left_semi") if few else docs
        found, _ = materialize(cut_regions(holding, length, cut_up), f"pieces-{level}")
        shared, _ = materialize(found.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("gram"), f"names-{level}")


def crowded(found: DataFrame, what: str) -> list[int]:
    """Names with more than CROWD different ``what``: at most one in CROWD of the rows."""
    often = found.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > CROWD).select("gram").collect()
    met = found.where(F.col("gram").isin([r.gram for r in often])).groupBy("gram").agg(F.approx_count_distinct(what).alias("different"))
    return [r.gram for r in met.where(F.col("different") > CROWD).select("gram").collect()] if often else []


def cut_regions(docs: DataFrame, length: int, crowds: list[frozenset[int]]) -> DataFrame:
    """Pieces of the regions of the grams in ``crowds[0]``, then of those pieces named in ``crowds[1]``.

    ``gram`` is a piece's name, ``body`` a hash of its bytes.
    """
    widths = WIDTHS[: len(crowds)]

    def places(batch: pa.RecordBatch) -> dict:
        rows: list[tuple[bytes, int, int, int, int]] = []
        powers = _powers(STRETCH + length)
        for key, text in zip(batch.column("key").to_pylist(), binary_lists(batch.column("text")), strict=True):
            for found in placed_regions(text, length, powers) if len(text) >= length else ():
                for start, n, name, gram in zip(*(x.tolist() for x in found), strict=True):
                    parts = [(start, n, name)]
                    for names, width in zip(crowds, widths, strict=True):
                        parts = [x for a, m, name in parts if name in names for x in pieces(text, a, m, gram, length, width)]
                    for a, m, name in parts:
                        body = hashlib.md5(text[a : a + m + length - 1], usedforsecurity=False).digest()
                        rows.append((key, a, m, name, int.from_bytes(body[:8], "little", signed=True)))
        columns = zip(*rows, strict=True) if rows else [()] * 5
        kinds = {"key": pa.binary(), "start": pa.int64(), "n": pa.int32(), "gram": pa.int64(), "body": pa.int64()}
        return {c: pa.array(x, k) for (c, k), x in zip(kinds.items(), columns, strict=True)}

    return per_batch(docs.select("key", "text"), places, "key binary, start long, n int, gram long, body long")


def repeated_spans(docs: DataFrame, length: int = 400, cut_crowds: bool = True) -> DataFrame:
    """(key, spans): for each text digest with repeats, what ``merged`` turns into stretches.

    A stretch is covered by strings of ``length`` bytes that also start somewhere else in
    ``docs`` (rows with a column key from ``keyed``), the same document included. A region that
    recurs within a text is one row with the list of its places, so periodic texts stay small.
    All columns of ``docs`` take part, so that a join of ``docs`` with the result on key finds
    its texts shuffled already. The result is the same without ``cut_crowds``; then all regions of a
    gram meet in one task, however many, and less disk is needed.
    """
    if length < GRAM + 8:
        raise ValueError(f"length must be {GRAM + 8} at least")
    wanted = candidates(docs, length, cut_crowds).groupBy("key").agg(F.collect_set(F.struct("start", "n", "gram")).alias("at"))

    def cuts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, Iterator[tuple[bytes, bytes, dict]]]]:
        for key, text, at in zip(batch.column("key").to_pylist(), binary_lists(batch.column("text")), batch.column("at").to_pylist(), strict=True):
            found = ((r, text[r["start"] : r["start"] + r["n"] + length - 1]) for r in at)
            yield key, ((hashlib.md5(body).digest(), body, r) for r, body in found)

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list] = {}
            for _, found in cuts(batch):
                for name, body, r in found:
                    held.setdefault(name, [r["gram"], body, 0])[2] += 1
            yield pa.RecordBatch.from_pydict({
                "region": pa.array(list(held), pa.binary()),
                "gram": pa.array([v[0] for v in held.values()], pa.int64()),
                "body": pa.array([v[1] for v in held.values()], pa.binary()),
                "times": pa.array([v[2] for v in held.values()], pa.int64()),
            })

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            places: dict[tuple[bytes, bytes], list[int]] = {}
            for key, found in cuts(batch):
                for name, _, r in found if key != last else ():  # a copy of the document before has the same places
                    places.setdefault((key, name), []).append(r["start"])
                last = key
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([k for k, _ in places], pa.binary()),
                "starts": pa.array(list(places.values()), pa.list_(pa.int64())),
                "region": pa.array([r for _, r in places], pa.binary()),
            })

    # Cut twice from one shuffle of the texts: less disk than the written regions and a second shuffle.
    whole = cut(docs.join(wanted, "key"))
    at = whole.mapInArrow(homes, "key binary, starts array<long>, region binary")

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple[bytes, bytes, int]] = []
        size, gram = 0, None
        for batch in batches:
            for g, region, body, times in zip(*(batch.column(c).to_pylist() for c in ("gram", "region", "body", "times")), strict=True):
                if g != gram and size >= BLOCK:
                    yield _sorted_block(block, length)
                    block, size = [], 0
                gram = g
                block.append((region, body, times))
                size += len(body)
        if block:
            yield _sorted_block(block, length)

    # Dealt by gram before regions are counted, so that they travel once; a batch of documents holds a region once.
    sent = whole.mapInArrow(bodies, "region binary, gram long, body binary, times long").repartition("gram")
    meeting = sent.groupBy("gram", "region").agg(F.first("body").alias("body"), F.sum("times").alias("times")).sortWithinPartitions("gram")
    hits = cut(meeting).mapInArrow(repeats, "region binary, first array<long>, stop array<long>")
    return at.join(hits, "region").groupBy("key").agg(F.collect_list(F.struct("starts", "first", "stop")).alias("spans"))


def _sorted_block(block: list[tuple[bytes, bytes, int]], length: int) -> pa.RecordBatch:
    """Runs of repeated starts within each region of a block."""
    text = b"".join(b for _, b, _ in block)
    sizes = np.array([len(b) for _, b, _ in block])
    begins = np.cumsum(sizes) - sizes
    weight = np.zeros(len(text), np.int64)  # of a start: 0 where a string would leave its region
    for at, size, (_, _, times) in zip(begins.tolist(), sizes.tolist(), block, strict=True):
        weight[at : at + size - length + 1] = min(times, 2)
    order = suffix_array(text, length)
    run = np.concatenate([[0], np.cumsum(~adjacent_prefixes(text, order, length))])
    often = np.bincount(run, weights=weight[order]) > 1
    hit = np.zeros(len(text) + 1, bool)
    hit[order] = often[run] & (weight[order] > 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit]).astype(np.int8)))
    first, stop = edge[::2], edge[1::2] - 1 + length
    owner = np.searchsorted(begins, first, side="right") - 1
    named = np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0])) if len(owner) else owner
    offsets = pa.array(np.concatenate([named, [len(owner)]]), pa.int32())
    return pa.RecordBatch.from_pydict({
        "region": pa.array([block[i][0] for i in owner[named].tolist()], pa.binary()),
        "first": pa.ListArray.from_arrays(offsets, pa.array(first - begins[owner], pa.int64())),
        "stop": pa.ListArray.from_arrays(offsets, pa.array(stop - begins[owner], pa.int64())),
    })


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs (start, stop) of a text, in order; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for s in sorted({(at + a, at + b) for s in spans or () for at in s["starts"] for a, b in zip(s["first"], s["stop"], strict=True)}):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def keep(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for run in runs for x in run), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def whole_characters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs drawn in to the characters that lie wholly inside."""
    inside = lambda i: i < len(text) and text[i] & 0xC0 == 0x80
    out = []
    for a, b in runs:
        while inside(a):
            a += 1
        while inside(b):
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame, length: int) -> DataFrame:
    """``docs`` (doc_id, text, lang, source) without repeated passages, with n_chars of what is left.

    Every copy of a passage goes, cut at whole characters. Documents stay, also if nothing is left.
    Crowds aren't cut: at 256 bytes the pipeline then took more than its disk on the check tool's hot table.
    """
    docs = keyed(docs, "doc_id", "lang", "source")
    marked = docs.join(repeated_spans(docs, length, cut_crowds=False), "key", "left").select("doc_id", "text", "lang", "source", "spans")

    def rows(batch: pa.RecordBatch) -> dict:
        texts = []
        for text, spans in zip(binary_lists(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
            texts.append(keep(text, whole_characters(text, merged(spans))).decode())
        return {n: batch.column(n) for n in ["doc_id", "lang", "source"]} | {"text": texts, "n_chars": pa.array(map(len, texts), pa.int64())}

    kinds = dict(marked.dtypes)
    schema = ", ".join(f"{n} {kinds[n]}" for n in ("doc_id", "lang", "source")) + ", text string, n_chars long"
    return per_batch(marked, rows, schema)


def suffix_query(spark, sf_dir: str) -> DataFrame:
    """Digest columns of each document and ``text``, what is left of it at whole characters."""
    docs = keyed(table(spark, sf_dir, "documents"), "doc_id")
    marked = docs.join(repeated_spans(docs, 400), "key", "left").select("doc_id", "text", "spans")

    def rows(batch: pa.RecordBatch) -> dict:
        texts = binary_lists(batch.column("text"))
        runs = [merged(s) for s in batch.column("spans").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "n_bytes": pa.array(map(len, texts), pa.int64()),
            "n_removed": pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()),
            "n_spans": pa.array(map(len, runs), pa.int64()),
            "kept_sha256": [hashlib.sha256(keep(t, r)).hexdigest() for t, r in zip(texts, runs, strict=True)],
            "text": [keep(t, whole_characters(t, r)).decode() for t, r in zip(texts, runs, strict=True)],
        }

    return per_batch(marked, rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")
