"""Near-duplicate groups by SimHash fingerprints in a grid, and an exact prefix join for what these leave apart.

Candidates come from the fingerprints of ``simhash`` first: texts of one fingerprint, and fingerprints
that the grid of segment counts brings within a few bits. Each is verified by the exact Jaccard
similarity. A near copy may lie further off than any small radius, as a handful of edits moves a
fingerprint by several bits, so an exact join on the rarest word shingles follows for texts that
are still in different groups.

Two sets with a Jaccard similarity of at least s share all but a share 1 - s of each. Put in one order
for all texts, the first n - ceil(s * n) + 1 shingles of both therefore have one in common. The order
is by the number of texts that have a shingle: a text with enough shingles of its own has no near
copy, and passages that many texts share come last. So all candidates are texts with a common prefix
shingle, whatever their length, and each is verified by the exact Jaccard similarity.

Of a group of copies not all pairs are needed, only what connects them. The texts of a prefix shingle
are first held against their most central one, and so on for those that are not of its group. Then
the texts that are still in different groups are joined on their prefix shingles, under two bounds
that no near copy fails: what can still be common from the first common shingle on, by its place in
both texts, and the number of different shingles, of which a bitmap of parities differs in as many
bits at most. Neither leaves a near copy out, and what passes is verified by the sets.

Shingles are counted in numpy: they travel as arrays, dealt by the first bits of their hashes, and
those that several texts share come back to the texts, some hundreds of which are a chunk.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.frames import binary_lists, cut, materialize, per_batch
from tallygrain.llm.graph import components
from tallygrain.llm.simhash import fingerprints, hashes, shingles
from tallygrain.llm.simhash import links as grid_links

#: Parts that shingles are dealt to, and texts of a chunk, as bits.
PART_BITS, CHUNK_BITS = 10, 9
#: Bits of an id below its partition (monotonically_increasing_id).
HOME_BITS = 33
#: Bits of a text's parities, in words of 64: wide enough for texts of some 2000 shingles.
WORDS = 16
#: Rounds against central texts at most, and pairs for each row from which on another round is worth it.
ROUNDS, WORTH = 4, 4
#: Rows of a table of numbers that is broadcast at most.
SMALL = 250_000


def shingle_set(text: bytes, size: int) -> np.ndarray:
    return np.unique(hashes(shingles(text, size)))


def parities(numbers: np.ndarray) -> list[int]:
    """Of each value of the last bits, whether an odd number of shingles has it, as 64-bit words.

    A shingle that only one of two texts has turns one bit, so two bitmaps differ in no more bits
    than the texts have different shingles.
    """
    odd = np.bincount((numbers & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _slices(by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first places, stops) of the runs of equal values."""
    if not len(by):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
    return first, np.concatenate([first[1:], [len(by)]])


def _joined(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def prefixes(texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """(token, id, n, place, score): prefix shingles of (id, text) that other texts have as well.

    ``token`` is the first 42 bits of a shingle's hash, n the number of the text's shingles. Shingles
    with the same token count as often as both, which keeps the order one for all. ``place`` is the
    number of the text's shingles before the first with that token. ``score`` is higher the more texts
    share the shingles of this one.
    """
    parts = 1 << PART_BITS

    def deal(batch: pa.RecordBatch) -> dict:
        ids = batch.column("id").to_numpy()
        sets = [shingle_set(t, size) for t in binary_lists(batch.column("text"))]
        n = np.array([len(s) for s in sets])
        home, place = ids >> HOME_BITS, (ids & ((1 << HOME_BITS) - 1)).astype(np.uint32)
        out: dict[str, list] = {"part": [], "home": [], "token": [], "place": []}
        for h in np.unique(home).tolist():
            here = np.flatnonzero(home == h)
            all_of = np.concatenate([sets[i] for i in here])
            order = np.argsort(all_of, kind="stable")
            all_of, at = all_of[order], np.repeat(place[here], n[here])[order]
            part = (all_of >> np.uint64(64 - PART_BITS)).astype(np.int64)
            token = ((all_of >> np.uint64(32 - PART_BITS)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            for a, b in zip(*map(np.ndarray.tolist, _slices(part)), strict=True):
                for name, value in (("part", int(part[a])), ("home", h), ("token", token[a:b].tobytes()), ("place", at[a:b].tobytes())):
                    out[name].append(value)
            # the sizes travel along, in parts of their own
            for name, value in (("part", parts + h % parts), ("home", h), ("token", n[here].astype(np.uint32).tobytes()), ("place", place[here].tobytes())):
                out[name].append(value)
        return {
            "part": pa.array(out["part"], pa.int32()), "home": pa.array(out["home"], pa.int64()),
            "token": pa.array(out["token"], pa.binary()), "place": pa.array(out["place"], pa.binary()),
        }

    def shared(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        tokens, places = _joined(rows.column("token"), np.uint32), _joined(rows.column("place"), np.uint32)
        ids = np.repeat(rows.column("home").to_numpy() << HOME_BITS, [len(p) for p in places]) | np.concatenate(places).astype(np.int64)
        token = np.concatenate(tokens)
        times = np.zeros(len(token), np.uint32)
        if part < parts:
            order = np.argsort(token, kind="stable")
            token, ids = token[order], ids[order]
            first, stop = _slices(token)
            times = np.repeat(stop - first, stop - first).astype(np.uint32)
            token, ids, times = token[times > 1], ids[times > 1], times[times > 1]
        order = np.argsort(ids, kind="stable")
        token, ids, times = token[order], ids[order], times[order]
        chunk, place = ids >> CHUNK_BITS, (ids & ((1 << CHUNK_BITS) - 1)).astype(np.uint16)
        first, stop = _slices(chunk)
        cuts = list(zip(first.tolist(), stop.tolist(), strict=True))
        return pa.table({
            "chunk": pa.array(chunk[first], pa.int64()), "part": pa.array([part] * len(cuts), pa.int32()),
            "token": pa.array([token[a:b].tobytes() for a, b in cuts], pa.binary()),
            "place": pa.array([place[a:b].tobytes() for a, b in cuts], pa.binary()),
            "times": pa.array([times[a:b].tobytes() for a, b in cuts], pa.binary()),
        })

    def first_ones(rows: pa.Table) -> pa.Table:
        part = rows.column("part").to_numpy().astype(np.int64)
        tokens, places, times = (_joined(rows.column(c), k) for c, k in (("token", np.uint32), ("place", np.uint16), ("times", np.uint32)))
        n, log = np.zeros(1 << CHUNK_BITS, np.int64), np.zeros(1 << CHUNK_BITS)
        for i in np.flatnonzero(part >= parts):
            n[places[i]] = tokens[i]
        mine = np.flatnonzero(part < parts)
        join = lambda x, kind: np.concatenate([np.zeros(0, kind), *(x[i] for i in mine)])
        token = np.repeat(part[mine] << 32, [len(tokens[i]) for i in mine]) | join(tokens, np.int64).astype(np.int64)
        place, often = join(places, np.uint16).astype(np.int64), join(times, np.int64).astype(np.int64)
        held = np.bincount(place, minlength=len(n))
        log = np.bincount(place, weights=np.log2(often), minlength=len(n)) / np.maximum(n, 1)
        # what the shingles of its own leave of the prefix
        left = n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1 - (n - held)
        order = np.lexsort((token, often, place))
        token, place = token[order], place[order]
        first, stop = _slices(place)
        rank = np.arange(len(place)) - np.repeat(first, stop - first)
        good = rank < left[place]
        token, place, before = token[good], place[good], rank[good] + (n - held)[place[good]]
        first, _ = _slices(np.stack([place, token], 1).view([("p", np.int64), ("t", np.int64)]).ravel())
        token, place, before = token[first], place[first], before[first]
        base = rows.column("chunk")[0].as_py() << CHUNK_BITS
        return pa.table({"token": pa.array(token, pa.int64()), "id": pa.array(place + base, pa.int64()), "n": pa.array(n[place], pa.int64()), "place": pa.array(before, pa.int64()), "score": pa.array(log[place], pa.float64())})

    dealt = per_batch(texts.select("id", "text"), deal, "part int, home long, token binary, place binary")
    back = cut(dealt.groupBy("part").applyInArrow(shared, "chunk long, part int, token binary, place binary, times binary"))
    found = back.groupBy("chunk").applyInArrow(first_ones, "token long, id long, n long, place long, score double")
    return found


def _small(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= SMALL else rows


def verified(pairs: DataFrame, sets: DataFrame, similarity: float, n: int | None = None) -> DataFrame:
    """The pairs (a, b) whose shingle sets (id, set) have at least this Jaccard similarity.

    Of few pairs (``n``, if known) only the sets that stand in them travel.
    """
    if n is not None and n <= SMALL:
        sets = sets.join(F.broadcast(pairs.select(F.explode(F.array("a", "b")).alias("id"))), "id", "left_semi")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"
    )

    def compare(batch: pa.RecordBatch) -> dict | None:
        good = []
        for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common and common >= similarity * (len(x) + len(y) - common):
                    good.append(i)
        return {"a": batch.column("a").take(pa.array(good, pa.int32())), "b": batch.column("b").take(pa.array(good, pa.int32()))} if good else None

    return per_batch(both.select("a", "b", "sa", "sb"), compare, "a long, b long")


def close_prints(texts: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of (id, text) by SimHash fingerprint, not verified.

    Each text of a fingerprint stands against the one with the smallest id, and these against
    those of the fingerprints that the grid finds within ``radius`` bits.
    """
    count = F.count(F.lit(1))
    prints, _ = materialize(fingerprints(texts.select(F.col("id").alias("doc_id"), "text")), "fingerprints")
    nodes, several = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("node"), count.alias("n")), "nodes", {"n": F.count_if(F.col("n") > 1)})
    shared = nodes.where("n > 1").select("fp", "node")
    equal = prints.join(_small(shared, several["n"]), "fp").where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    edges, found = materialize(grid_links(nodes, radius), "edges", {"n": count})
    firsts = nodes.select(F.col("fp").alias("x"), F.col("node").alias("p")).join(_small(edges, found["n"]), "x")
    both = nodes.select(F.col("fp").alias("y"), F.col("node").alias("q")).join(_small(firsts, found["n"]), "y")
    return equal.union(both.select(F.least("p", "q"), F.greatest("p", "q")))


def near_duplicate_groups(texts: DataFrame, size: int = 5, similarity: float = 0.8, radius: int = 2) -> DataFrame:
    """(node, component) of texts with a near copy, for rows (id, text) of different texts.

    ``id`` is of monotonically_increasing_id. Texts of fewer than ``size`` words are one shingle;
    empty texts have no near copies. ``radius`` (0 to 3) is that of the fingerprints and doesn't
    alter the groups, only how many of their links the fingerprints find.
    """
    rows, _ = materialize(prefixes(texts, size, similarity), "prefixes")
    several = rows.groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("token")
    lists, here = materialize(rows.join(several, "token", "left_semi"), "lists", {"n": F.count(F.lit(1))})

    def numbers(batch: pa.RecordBatch) -> dict:
        found = [shingle_set(t, size) for t in binary_lists(batch.column("text"))]
        return {"id": batch.column("id"), "set": pa.array([s.tobytes() for s in found], pa.binary()), "bits": pa.array(map(parities, found), pa.list_(pa.int64()))}

    named = lists.select("id").distinct()
    sets, _ = materialize(per_batch(texts.join(named, "id", "left_semi").select("id", "text"), numbers, "id long, set binary, bits array<long>"), "sets")

    def alike(x: str, y: str):
        return F.least(x, y) >= similarity * F.greatest(x, y) - 1e-9

    def grouped(links: DataFrame) -> DataFrame:
        found, _ = materialize(components(links), "groups")
        return found

    # A near copy has a prefix shingle in common, so a text without a set here has none.
    tried, close = materialize(close_prints(texts, radius), "close", {"n": F.count(F.lit(1))})
    links, _ = materialize(verified(tried, sets, similarity, close["n"]), "links")
    rest = lists.withColumn("group", F.col("id"))
    for _ in range(ROUNDS):
        best = rest.groupBy("token").agg(F.max(F.struct("score", "id", "n")).alias("best"))
        best = best.select("token", F.col("best.id").alias("central"), F.col("best.n").alias("m"))
        near = rest.join(best, "token").where(F.col("id") != F.col("central")).where(alike("n", "m"))
        pairs = near.select(F.least("id", "central").alias("a"), F.greatest("id", "central").alias("b")).distinct()
        pairs, _ = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        good, _ = materialize(verified(pairs, sets, similarity), "links")
        links, tried = links.union(good), tried.union(pairs)
        groups = grouped(links)
        named = groups.select(F.col("node").alias("id"), F.col("component"))
        with_group = lambda df, named=named: df.drop("group").join(named, "id", "left").withColumn("group", F.coalesce("component", "id")).drop("component")
        top = with_group(best.select("token", F.col("central").alias("id"))).select("token", F.col("group").alias("top"))
        left = with_group(rest).join(top, "token").where("group != top").drop("top")
        rest, now = materialize(left.select("token", "id", "n", "place", "score", "group"), "rest", {"n": F.count(F.lit(1))})
        sizes = rest.groupBy("token", "group").agg(F.count(F.lit(1)).cast("double").alias("k")).groupBy("token")
        cross = sizes.agg(((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("c")).agg(F.sum("c")).first()[0] or 0
        if not now["n"] or cross <= WORTH * here["n"]:
            break
    # Texts in different groups: only tokens of several groups, only pairs that both bounds let through.
    several = with_group(lists).groupBy("token", "group").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(F.count(F.lit(1)).alias("k"))
    mixed = with_group(lists).join(several.where("k > 1").select("token"), "token", "left_semi")
    mixed, _ = materialize(mixed.join(sets.select("id", "bits"), "id").select("token", "group", "id", "n", "place", "bits"), "members")
    x, y = mixed.alias("x"), mixed.alias("y")
    total = F.col("x.n") + F.col("y.n")
    different = sum((F.bit_count(F.get("x.bits", F.lit(i)).bitwiseXOR(F.get("y.bits", F.lit(i)))) for i in range(WORDS)), F.lit(0))
    bounds = [
        F.col("x.token") == F.col("y.token"),
        F.col("x.group") < F.col("y.group"),
        alike("x.n", "y.n"),
        F.least(F.expr("x.n - x.place"), F.expr("y.n - y.place")) >= total * (similarity / (1 + similarity)) - 1e-6,
        different <= total * ((1 - similarity) / (1 + similarity)) + 1e-6,
    ]
    cross = x.join(y, reduce(and_, bounds)).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    pairs, last = materialize(cross.join(tried, ["a", "b"], "left_anti"), "pairs", {"n": F.count(F.lit(1))})
    good, _ = materialize(verified(pairs, sets, similarity, last["n"]), "links")
    return components(links.union(good))


def one_of_each(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` without all but one document of each group of exact and near copies.

    The document with the smallest doc_id stays (null ids last). Copies are known by the digest of
    their text, so a text with thousands of copies is looked at as one. Null texts are taken as
    empty ones. All columns of ``docs`` are kept.
    """
    key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).alias("key")
    least = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("least")
    rows = docs.select(F.struct(*docs.columns).alias("row"), least, key)
    firsts = rows.groupBy("key").agg(F.min_by("row", "least").alias("row"), F.min("least").alias("least"))
    firsts, _ = materialize(firsts.select("key", "least", "row", F.monotonically_increasing_id().alias("id")), "texts")
    texts = firsts.select("id", F.col("row.text").alias("text")).where("length(text) > 0")
    found, _ = materialize(near_duplicate_groups(texts, size, similarity), "groups")
    order = firsts.select(F.col("id").alias("node"), "least", "key").join(found, "node").select("component", F.struct("least", "key", "node").alias("rank"))
    stays = order.groupBy("component").agg(F.min("rank").alias("best")).select(F.col("best.node").alias("node"))
    gone, _ = materialize(found.select("node").join(stays, "node", "left_anti"), "gone")
    return firsts.join(gone.withColumnRenamed("node", "id"), "id", "left_anti").select("row.*")
