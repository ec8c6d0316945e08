"""Periodic runs of words, caught online by completed power-of-two blocks.

Words are appended to a stream. When the block of words [b, b + 2^k) is complete, a catcher stands on
it for the periods of its level: a run of period p that is long enough repeats some whole block of
the level p words later. Each appended word closes one window of 2^k words for each level, which is
compared with the blocks that stand at the level's distances: one or two of them. Windows are
compared by hashes that are put together from those of half their size. What is caught is a new
square; squares of one period whose blocks follow each other merge, and are extended word by word,
into maximal runs.

Work is n words times the levels, whatever the text; squares inside a run of a shorter period are
passed over, as the longer period then is a multiple of the shorter one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.frames import binary_lists, cut, pick, table
from tallygrain.llm.prefix_trie import CRC

#: Words of a stream, about: documents of like length share one.
STREAM_WORDS = 1 << 18
RUN = "struct<start:long,length:long,period:long>"


def levels(min_length: int, exponent: int, most: int) -> list[tuple[int, int, int]]:
    """(k, least period, largest period) of the catchers for runs of at least ``min_length`` words and
    ``exponent`` periods, among texts of ``most`` words.

    A run of period p agrees with itself p words on over max(min_length - p, (exponent - 1) p) words;
    any 2^(k+1) - 1 words hold a whole block of 2^k.
    """
    top = most // exponent
    p = np.arange(1, top + 1)
    if not len(p):
        return []
    agree = np.maximum(min_length - p, (exponent - 1) * p)
    agree = np.minimum.accumulate(agree[::-1])[::-1]
    k = np.maximum(np.floor(np.log2((agree + 1) / 2) + 1e-9).astype(int), 0)
    return [(int(v), int(p[k == v].min()), int(p[k == v].max())) for v in np.unique(k)]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SquareCatcher:
    """The catchers of one stream of word numbers.

    ``longest`` bounds the documents of the stream; documents are told apart by words that occur once.
    ``append`` takes any number of words, ``runs`` tells the runs of all that was appended.
    """

    def __init__(self, min_length: int, exponent: int, longest: int):
        self.min_length, self.exponent = min_length, exponent
        self.levels = levels(min_length, exponent, longest)
        self.words = np.zeros(0, np.int64)
        #: Hashes of the windows of 2^k words from each place on.
        self.windows = [np.zeros(0, np.uint64) for _ in range(1 + max((k for k, _, _ in self.levels), default=-1))]
        self.caught: dict[int, list[np.ndarray]] = {k: [] for k, _, _ in self.levels}
        #: Windows of each level that the catchers have seen.
        self.advanced = dict.fromkeys(self.caught, 0)

    def append(self, words: np.ndarray) -> int:
        """Advances all catchers; returns the number of squares that were caught."""
        self.words = np.concatenate([self.words, words])
        n, new = len(self.words), 0
        for k, known in enumerate(self.windows):
            first, last = len(known), n - (1 << k) + 1
            if last <= first:
                break
            if k == 0:
                fresh = _mixed(self.words[first:].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            else:
                half, below = 1 << (k - 1), self.windows[k - 1]
                with np.errstate(over="ignore"):
                    fresh = _mixed(below[first:last] * np.uint64(0x9E3779B97F4A7C15) + below[first + half : last + half])
            self.windows[k] = np.concatenate([known, fresh]) if len(known) else fresh
        for k, least, most in self.levels:
            h = self.windows[k]
            at = np.arange(self.advanced[k], len(h))
            self.advanced[k] = len(h)
            for j in range(least >> k, (most >> k) + 1):
                block = ((at >> k) - j) << k
                period = at - block
                ok = (block >= 0) & (period >= least) & (period <= most)
                ok[ok] = h[block[ok]] == h[at[ok]]
                if ok.any():
                    self.caught[k].append(np.stack([period[ok], block[ok]]))
                    new += int(ok.sum())
        return new

    def runs(self) -> np.ndarray:
        """Rows (start, length, smallest period) of the maximal runs, by start and period."""
        found: list[tuple[int, int, int]] = []
        for k, _, _ in self.levels:
            if not self.caught[k]:
                continue
            period, block = np.concatenate(self.caught[k], axis=1)
            order = np.lexsort((block, period))
            period, block = period[order], block[order]
            ends = np.flatnonzero((period[1:] != period[:-1]) | (block[1:] != block[:-1] + (1 << k)))
            first, last = np.concatenate([[0], ends + 1]), np.concatenate([ends, [len(block) - 1]])
            p, lo, hi = period[first], block[first], block[last] + (1 << k)
            keep = ~self._inside(found, lo, hi + p, p)
            for q, a, b in zip(p[keep].tolist(), lo[keep].tolist(), hi[keep].tolist(), strict=True):
                found += self._extended(q, a, b, (1 << k) - 1)
        if not found:
            return np.zeros((0, 3), np.int64)
        rows = np.array(sorted(set(found)), np.int64)
        # Of the periods of one stretch, the smallest.
        same = np.concatenate([[False], (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 1])])
        rows = rows[~same]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]

    def _inside(self, found: list[tuple[int, int, int]], lo: np.ndarray, hi: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Which stretches lie in a run of a period that divides theirs."""
        if not found:
            return np.zeros(len(lo), bool)
        rows = np.array(sorted(found), np.int64)
        end = rows[:, 0] + rows[:, 1]
        furthest = np.maximum.accumulate(end)
        # The first run to reach as far: of equal stretches, that of the smallest period.
        which = np.maximum.accumulate(np.where(np.concatenate([[True], end[1:] > furthest[:-1]]), np.arange(len(end)), 0))
        at = np.searchsorted(rows[:, 0], lo, side="right") - 1
        by = which[np.maximum(at, 0)]
        q = rows[by, 2]
        return (at >= 0) & (furthest[np.maximum(at, 0)] >= hi) & (period % q == 0) & (hi - lo >= period + q)

    def _extended(self, p: int, lo: int, hi: int, reach: int) -> list[tuple[int, int, int]]:
        """The maximal stretches of period p around the words [lo, hi) that agree with those p words on."""
        a, b = max(0, lo - reach - 1), min(len(self.words) - p, hi + reach + 1)
        agree = np.concatenate([[False], self.words[a:b] == self.words[a + p : b + p], [False]])
        edges = np.flatnonzero(agree[1:] != agree[:-1])
        least = max(self.min_length - p, (self.exponent - 1) * p)
        return [(a + s, e - s + p, p) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if e - s >= least]


def runs_of(texts: list[list[int]], min_length: int, exponent: int) -> list[np.ndarray]:
    """The runs of each list of word numbers (all below 2^62); lists of like length share a stream."""
    out: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(texts)
    by_size = sorted((i for i, t in enumerate(texts) if len(t) >= max(min_length, exponent)), key=lambda i: -len(texts[i]))
    while by_size:
        take, size, longest = 0, 0, len(texts[by_size[0]])
        while take < len(by_size) and size < STREAM_WORDS and 2 * len(texts[by_size[take]]) >= longest:
            size += len(texts[by_size[take]]) + 1
            take += 1
        group, by_size = by_size[:take], by_size[take:]
        catcher = SquareCatcher(min_length, exponent, longest)
        parts, starts, at = [], [], 0
        for i in group:
            starts.append(at)
            parts += [np.array(texts[i], np.int64), np.array([(1 << 62) + at], np.int64)]
            at += len(texts[i]) + 1
        catcher.append(np.concatenate(parts))
        rows = catcher.runs()
        cuts = np.searchsorted(rows[:, 0], [*starts, at])
        for i, start, a, b in zip(group, starts, cuts, cuts[1:]):
            out[i] = rows[a:b] - np.array([start, 0, 0])
    return out


def without_repeats(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not len(runs):
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, *keep: str, min_length: int = 24, exponent: int = 3) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_words, runs and collapsed text of ``text``.

    Words are what white space of ASCII parts; null texts have none. A run is a stretch of words with
    smallest period q and a length of at least ``min_length`` and ``exponent`` (2 or more) periods that
    can't be extended; ``runs`` has (start, length, period) by start, then period. ``collapsed`` are the
    words outside all runs, and of each run the first period, unless another run drops it, joined by
    spaces. One row for each row of ``docs``, repeats and null keys included; no shuffle.
    """
    if exponent < 2 or min_length < 1:
        raise ValueError("exponent must be 2 at least, min_length 1")
    rows = pick(docs, "text", *keep).withColumnRenamed("text", "_text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [t.split() for t in binary_lists(batch.column("_text"))]
            number: dict[bytes, int] = {}
            found = runs_of([[number.setdefault(w, len(number)) for w in ws] for ws in words], min_length, exponent)
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in keep}
                | {
                    "n_words": [len(ws) for ws in words],
                    "runs": pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in f.tolist()] for f in found],
                                     pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))),
                    "collapsed": pa.array([b" ".join(without_repeats(ws, f)).decode("utf-8", "replace") for ws, f in zip(words, found, strict=True)], pa.string()),
                }
            )

    return cut(rows).mapInArrow(run, f"{schema}, n_words long, runs array<{RUN}>, collapsed string")


def with_period(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with one text in ten, by crc32 of the decimal key, made periodic from some word on."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    n, g = F.size("_words"), F.floor(F.col("_h") / 10)
    a = F.when(n > 0, (g % n).cast("int"))
    p = (1 + F.floor((n - F.col("_a")) / (3 + g % 8))).cast("int")
    start, period = F.col("_a"), F.col("_p")
    turned = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_words", F.when(i >= start, start + (i - start) % period).otherwise(i)))
    steps = docs.withColumns({"_h": h, "_words": words}).withColumn("_a", a).withColumn("_p", p)
    return steps.withColumn(text, F.when(start.isNotNull(), F.array_join(turned, " ")).otherwise(F.col(text))).drop("_h", "_words", "_a", "_p")


def periodic_query(spark, sf_dir: str) -> DataFrame:
    """Runs of the texts of ``documents``, of which every tenth is made periodic."""
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = periodic_runs(with_period(docs, "doc_id", "text"), "doc_id")
    # Greatest length / period by exact products; runs come by start and period, so the first of equals stays.
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(r.length * a.period > a.length * r.period, r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "runs", "collapsed", best.alias("best"), lines.alias("lines")).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


PERIODIC_SQL = f"""
WITH h AS (SELECT doc_id, text, {CRC.replace('c::VARCHAR', 'doc_id::VARCHAR')} AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT *, len(ws) AS n, h // 10 AS g FROM h),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM g),
q AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS q FROM a),
d AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(n), lambda i: ws[1 + CASE WHEN i >= a THEN a + (i - a) % q ELSE i END]) END AS ws FROM q),
w AS (SELECT doc_id, n, unnest(ws) AS word, unnest(range(n)) AS i FROM d),
eq AS (SELECT x.doc_id, y.i - x.i AS p, x.i, x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS island
  FROM w AS x JOIN w AS y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
stretch AS (SELECT doc_id, p, min(i) AS start, count(*) + p AS length FROM eq GROUP BY doc_id, p, island HAVING count(*) + p >= greatest(24, 3 * p)),
runs AS (SELECT doc_id, start, length, min(p) AS period FROM stretch GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
told AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    list({{'s': start, 'l': length, 'p': period}} ORDER BY start, period) AS rs FROM runs GROUP BY doc_id),
best AS (SELECT *, list_reduce(rs, lambda a, r: CASE WHEN r.l * a.p > a.l * r.p THEN r ELSE a END) AS b FROM told)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.l::BIGINT AS length, b.p::BIGINT AS period, (1000 * b.l // b.p)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""
