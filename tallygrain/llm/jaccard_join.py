"""Exact Jaccard join of word shingles as a recursive join of Voronoi regions around pivots.

Jaccard distance is a metric, but most texts are at distance 1 from most others, so pivots for the
whole corpus would tell nothing. Pivots are elected where texts can be near: two sets with a
similarity of s or more share one of their rarest n - ceil(s n) + 1 shingles (anchors), rarity being
one order for the whole corpus. The texts of an anchor are a region.

Each round elects one pivot in every region, the text whose shingles are the most shared, and finds
the exact distance of all texts of the region to it: one distance a row, not one a pair.

- Texts within r of the pivot are its cell: linked, and connected with each other through it.
- By the triangle inequality, a text at distance v from the pivot can only be near texts at v - r to
  v + r. So of the cell (and of whatever else is connected with the pivot) only the boundary is
  replicated to what is left of the region: those that lie in the window of a text that is not
  connected with the pivot.
- What is left, with that boundary, is a region of the next round, with a pivot of its own.

Regions where all texts are connected are done. When few pairs are left, they are joined: pairs of
texts that are not connected, in the windows of all pivots they were measured against, and near
enough by the sizes of their sets and the places of the common anchor; each is verified.

Rarity is counted in numpy. Shingle hashes travel from chunks of texts to parts by their first bits;
a shingle that is frequent in a chunk travels as one count, so a line of a third of all texts makes
one entry a chunk and not one a text. Shared shingles come back to the chunks with their counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.frames import binary_lists, cut, materialize, per_batch, pick, table
from tallygrain.llm.graph import components
from tallygrain.llm.simhash import hashes, shingles

#: Texts of a chunk, as bits; parts at least, as bits, and texts for each part.
CHUNK_BITS, LEAST_BITS, TEXTS_A_PART = 9, 8, 4096
#: Times in a chunk from which on a shingle travels as a count.
FREQUENT = 16
#: Comparisons left for each row of the regions at which they are made, rounds of pivots at most, and ids to broadcast.
FEW, ROUNDS, SMALL = 512, 6, 500_000
EPS = 1e-9


def shingle_set(text: bytes, size: int) -> np.ndarray:
    return np.unique(hashes(shingles(text, size)))


def _runs(by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first places, stops) of the runs of equal values."""
    if not len(by):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
    return first, np.concatenate([first[1:], [len(by)]])


def _arrays(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


def anchors(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(token, id, n, place, score) for (id, text): anchors that other texts have as well, and a row with a null
    token for every text, which tells n, the number of its shingles.

    ``place`` is that of the anchor in the order of the text's shingles, rarest first; ``score`` is the
    higher the more texts share the shingles. ``id`` is of monotonically_increasing_id. A token stands
    for the first bits of a shingle's hash, the same number everywhere; shingles that agree in them
    count as one that is as frequent as both, so nothing is missed.
    """
    bits = max(LEAST_BITS, (max(texts.count(), 1) // TEXTS_A_PART).bit_length())
    parts = 1 << bits

    def deal(batch: pa.RecordBatch) -> dict:
        ids = batch.column("id").to_numpy()
        sets = [shingle_set(t, size) for t in binary_lists(batch.column("text"))]
        n = np.array([len(s) for s in sets], np.int64)
        rows: list[tuple] = []
        for chunk in np.unique(ids >> CHUNK_BITS).tolist():
            here = np.flatnonzero(ids >> CHUNK_BITS == chunk)
            place = (ids[here] & ((1 << CHUNK_BITS) - 1)).astype(np.uint16)
            all_of, at = np.concatenate([sets[i] for i in here]) >> np.uint64(32 - bits), np.repeat(place, n[here])
            order = np.argsort(all_of, kind="stable")
            all_of, at = all_of[order], at[order]
            part, token = (all_of >> np.uint64(32)).astype(np.int64), all_of.astype(np.uint32)
            first, stop = _runs(all_of)
            times = stop - first
            often = np.repeat(times >= FREQUENT, times)
            # At home stay the sizes, and who has the frequent ones.
            rows.append((chunk, -1, n[here].astype(np.uint32).tobytes(), place.tobytes(), all_of[often].astype(np.uint64).tobytes(), at[often].tobytes()))
            head = first[times >= FREQUENT]
            for a, b in zip(*map(np.ndarray.tolist, _runs(part)), strict=True):
                few = ~often[a:b]
                here_often = head[(head >= a) & (head < b)]
                rows.append((chunk, int(part[a]), token[a:b][few].tobytes(), at[a:b][few].tobytes(), token[here_often].tobytes(), times[np.searchsorted(first, here_often)].astype(np.uint16).tobytes()))
        chunk, part, *rest = zip(*rows, strict=True)
        return {"chunk": pa.array(chunk, pa.int64()), "part": pa.array(part, pa.int32())} | {c: pa.array(v, pa.binary()) for c, v in zip("abcd", rest, strict=True)}

    def counted(rows: pa.Table) -> pa.Table:
        chunk = rows.column("chunk").to_numpy()
        token, place, common, times = (_arrays(rows.column(c), k) for c, k in zip("abcd", (np.uint32, np.uint16, np.uint32, np.uint16), strict=True))
        few, many = _joined(token, np.uint32), _joined(common, np.uint32)
        names, which = np.unique(np.concatenate([few, many]), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate([np.ones(len(few)), _joined(times, np.float64)]), minlength=len(names)).astype(np.uint32)[which]
        ends_few, ends_many = np.cumsum([len(x) for x in token]), np.cumsum([len(x) for x in common])
        out: list[tuple] = []
        for i, c in enumerate(chunk.tolist()):
            mine = total[ends_few[i] - len(token[i]) : ends_few[i]]
            shared = mine > 1
            theirs = total[len(few) + ends_many[i] - len(common[i]) : len(few) + ends_many[i]]
            if shared.any() or len(theirs):
                out.append((c, token[i][shared].tobytes(), place[i][shared].tobytes(), mine[shared].tobytes(), common[i].tobytes(), theirs.tobytes()))
        part = rows.column("part")[0].as_py()
        chunk, *rest = zip(*out, strict=True) if out else [()] * 6
        return pa.table({"chunk": pa.array(chunk, pa.int64()), "part": pa.array([part] * len(chunk), pa.int32())} | {c: pa.array(v, pa.binary()) for c, v in zip("abcde", rest, strict=True)})

    def rarest(rows: pa.Table) -> pa.Table:
        part = rows.column("part").to_numpy().astype(np.uint64)
        chunk = rows.column("chunk")[0].as_py()
        n, log = np.zeros(1 << CHUNK_BITS, np.int64), np.zeros(1 << CHUNK_BITS)
        there = np.zeros(1 << CHUNK_BITS, bool)
        token, place, often, common, common_times, home, home_place = ([] for _ in range(7))
        columns = [rows.column(c).to_pylist() for c in "abcde"]
        for i, (a, b, c, d, e) in enumerate(zip(*columns, strict=True)):
            if part[i] == np.uint64(1 << 63):
                at = np.frombuffer(b, np.uint16)
                n[at], there[at] = np.frombuffer(a, np.uint32), True
                home.append(np.frombuffer(c, np.uint64))
                home_place.append(np.frombuffer(d, np.uint16))
            else:
                high = part[i] << np.uint64(32)
                token.append(np.frombuffer(a, np.uint32).astype(np.uint64) | high)
                place.append(np.frombuffer(b, np.uint16))
                often.append(np.frombuffer(c, np.uint32))
                common.append(np.frombuffer(d, np.uint32).astype(np.uint64) | high)
                common_times.append(np.frombuffer(e, np.uint32))
        home_token, common_token, times = _joined(home, np.uint64), _joined(common, np.uint64), _joined(common_times, np.uint32)
        order = np.argsort(common_token)
        known = times[order][np.searchsorted(common_token[order], home_token)] if len(home_token) else times[:0]
        all_of = np.concatenate([_joined(token, np.uint64), home_token]).astype(np.int64)
        at = np.concatenate([_joined(place, np.uint16), _joined(home_place, np.uint16)]).astype(np.int64)
        freq = np.concatenate([_joined(often, np.uint32), known]).astype(np.int64)
        held = np.bincount(at, minlength=len(n))
        log = np.bincount(at, weights=np.log2(np.maximum(freq, 1)), minlength=len(n)) / np.maximum(n, 1)
        order = np.lexsort((all_of, freq, at))
        all_of, at = all_of[order], at[order]
        first, stop = _runs(at)
        rank = np.arange(len(at)) - np.repeat(first, stop - first) + (n - held)[at]
        good = rank < (n - -(-percent * n // 100) + 1)[at]
        all_of, at, rank = all_of[good], at[good], rank[good]
        everyone = np.flatnonzero(there)
        ids = np.concatenate([at, everyone])
        return pa.table({
            "token": pa.concat_arrays([pa.array(all_of, pa.int64()), pa.nulls(len(everyone), pa.int64())]), "id": pa.array(ids + (chunk << CHUNK_BITS), pa.int64()),
            "n": pa.array(n[ids], pa.int64()), "place": pa.array(np.concatenate([rank, np.zeros(len(everyone), np.int64)]), pa.int64()), "score": pa.array(log[ids], pa.float64()),
        })

    dealt = per_batch(texts.select("id", "text"), deal, "chunk long, part int, a binary, b binary, c binary, d binary")
    # Written once, so that sizes and shingles come from one pass over the texts.
    away = dealt.withColumn("home", F.col("part") < 0)
    to_parts = away.withColumn("to", F.when(F.col("home"), F.col("chunk")).otherwise(F.col("part").cast("long")))

    def by_part(rows: pa.Table) -> pa.Table:
        if rows.column("home")[0].as_py():
            return pa.table({"chunk": rows.column("chunk"), "part": pa.array([None] * len(rows), pa.int32())} | {c: rows.column(c) for c in "abcd"} | {"e": pa.array([b""] * len(rows), pa.binary())})
        return counted(rows)

    back = cut(to_parts.groupBy("home", "to").applyInArrow(by_part, "chunk long, part int, a binary, b binary, c binary, d binary, e binary"))

    def by_chunk(rows: pa.Table) -> pa.Table:
        home = rows.column("part").is_null()
        part = np.where(home.to_numpy(zero_copy_only=False), np.uint64(1 << 63), rows.column("part").fill_null(0).to_numpy().astype(np.uint64))
        return rarest(rows.set_column(rows.schema.get_field_index("part"), "part", pa.array(part, pa.uint64())))

    return back.groupBy("chunk").applyInArrow(by_chunk, "token long, id long, n long, place long, score double").distinct()


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, either) of pairs (a, b) of texts with shingle sets (id, set): sizes of intersection and union."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"
    )

    def compare(batch: pa.RecordBatch) -> dict:
        common, either = [], []
        for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            common.append(len(np.intersect1d(x, y, assume_unique=True)))
            either.append(len(x) + len(y) - common[-1])
        return {"a": batch.column("a"), "b": batch.column("b"), "common": pa.array(common, pa.int64()), "either": pa.array(either, pa.int64())}

    return per_batch(both.select("a", "b", "sa", "sb"), compare, "a long, b long, common long, either long")


def joined_groups(texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """((node, component), (id, n)) for (id, text): what links of a similarity of ``percent`` or more connect, and the sizes of all sets.

    Texts without a link are not in the first table. ``id`` is of monotonically_increasing_id.
    """
    r = 1 - percent / 100
    found, _ = materialize(anchors(texts, size, percent), "anchors")
    sizes = found.where("token is null").select("id", "n")
    rows = found.where("token is not null")
    several = rows.groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("token")
    regions, here = materialize(rows.join(several, "token", "left_semi").withColumn("guest", F.lit(False)), "regions", {"n": F.count(F.lit(1))})

    def numbers(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column("id"), "set": pa.array([shingle_set(t, size).tobytes() for t in binary_lists(batch.column("text"))], pa.binary())}

    wanted, size_of = materialize(regions.select("id").distinct(), "wanted", {"n": F.count(F.lit(1))})
    wanted = F.broadcast(wanted) if size_of["n"] <= SMALL else wanted
    sets, _ = materialize(per_batch(texts.join(wanted, "id", "left_semi").select("id", "text"), numbers, "id long, set binary"), "sets")
    if not here["n"]:
        return components(regions.select(F.col("id").alias("a"), F.col("id").alias("b"))), sizes
    links, measured, windows, few = None, None, [], FEW * here["n"]
    linked = F.expr(f"100 * common >= {percent} * either")
    while True:
        pivots = regions.where("not guest").groupBy("token").agg(F.max(F.struct("score", "id")).alias("best")).select("token", F.col("best.id").alias("pivot"))
        ways = regions.join(pivots, "token").where("id <> pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
        fresh, _ = materialize(distances(ways if measured is None else ways.join(measured, ["a", "b"], "left_anti"), sets), "distances")
        measured = fresh if measured is None else measured.union(fresh)
        near = fresh.where(linked).select("a", "b")
        links = near if links is None else links.union(near)
        cells, _ = materialize(components(links).select(F.col("node").alias("id"), F.col("component").alias("group")), "cells")
        window = f"v{len(windows)}"
        away = measured.withColumn(window, 1 - F.col("common") / F.col("either"))
        to_pivot = away.select(F.col("a").alias("id"), F.col("b").alias("pivot"), window).union(away.select(F.col("b").alias("id"), F.col("a").alias("pivot"), window))
        placed = _in_groups(regions.drop("group"), cells, "id", "group").join(_in_groups(pivots, cells, "pivot", "top"), "token")
        placed = placed.join(to_pivot, ["id", "pivot"], "left").withColumn(window, F.coalesce(window, F.lit(0.0)))
        placed, _ = materialize(placed.withColumn("guest", F.col("group") == F.col("top")).drop("pivot", "top"), "placed")
        windows.append(window)
        per_region = placed.groupBy("token").agg(F.count(F.lit(1)).cast("double").alias("k"), F.count_if(~F.col("guest")).cast("double").alias("free"))
        left = per_region.agg(F.sum(F.col("free") * F.col("k"))).first()[0] or 0
        if left <= few or len(windows) >= ROUNDS:
            break
        # The boundary: connected with the pivot, and in the window of a text that is not.
        rest = placed.where("not guest").groupBy("token").agg(F.min(window).alias("low"), F.max(window).alias("high"))
        kept = placed.join(rest, "token").where(f"not guest or {window} between low - {r + EPS} and high + {r + EPS}").drop("low", "high")
        regions, _ = materialize(kept, "regions")
    # What is left, and the boundaries it has: all pairs that may be near and are not connected.
    x, y = placed.where("not guest").alias("x"), placed.alias("y")
    least = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    near = (F.col("x.token") == F.col("y.token")) & (F.col("x.group") != F.col("y.group")) & (F.col("y.guest") | (F.col("x.id") < F.col("y.id")))
    near = near & (100 * least >= percent * (F.col("x.n") + F.col("y.n") - least))
    for w in windows:
        near = near & (F.abs(F.col(f"x.{w}") - F.col(f"y.{w}")) <= r + EPS)
    pairs = x.join(y, near).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct().join(measured, ["a", "b"], "left_anti")
    last, _ = materialize(distances(pairs, sets).where(linked).select("a", "b"), "links")
    # These join cells, so only the cells' graph is left to connect.
    between = _in_groups(_in_groups(last, cells, "a", "ga"), cells, "b", "gb").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    whole, _ = materialize(components(between).select(F.col("node").alias("group"), "component"), "whole")
    nodes = cells.union(last.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(cells, "id", "left_anti").select("id", F.col("id").alias("group")))
    return nodes.join(whole, "group", "left").select(F.col("id").alias("node"), F.coalesce("component", "group").alias("component")), sizes


def _in_groups(rows: DataFrame, cells: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the cell of the text in ``key``; a text without a link is its own."""
    return rows.join(cells.select(F.col("id").alias(key), F.col("group").alias(name)), key, "left").withColumn(name, F.coalesce(name, key))


def jaccard_groups(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    The set of a text has the distinct runs of ``size`` words (lower case A-Z; fewer words: all of
    them as one). Texts are linked when 100 times the intersection is ``percent`` (1 to 100) times the
    union or more; component_id is the smallest doc_id reachable. Texts without words have no links.
    Copies are one text from the start. Rows without doc_id pass links on; a group of such rows
    only has a null component. Repeated rows stay repeated; an empty table gives an empty table.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be 1 to 100")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("key"))
    firsts = rows.groupBy("key").agg(F.first("text").alias("text"), F.min("doc_id").alias("least"))
    firsts, _ = materialize(firsts.withColumn("id", F.monotonically_increasing_id()), "texts")
    found, sizes = joined_groups(firsts.select("id", "text"), size, percent)
    names = firsts.select("key", "id", "least").join(sizes, "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left")
    names, _ = materialize(names.withColumn("component", F.coalesce("component", "id")), "names")
    smallest = names.groupBy("component").agg(F.min("least").alias("component_id"))
    named = names.join(smallest, "component").select("key", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), "component_id")
    out = rows.select("doc_id", "key").join(named, "key")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def jaccard_query(spark, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), 4, 85)


JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s AS x JOIN s AS y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT link.b AS doc_id, reach.c FROM reach JOIN link ON link.a = reach.doc_id)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reach.c) AS component_id FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.doc_id = w.doc_id GROUP BY w.doc_id
"""
