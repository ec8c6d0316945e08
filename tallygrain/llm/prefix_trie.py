"""Prefix trie of conversations with subtree totals rolled up in depth bands.

A node is a distinct sequence of the first d turns of a conversation. Its key is its depth and the
exclusive or of two 64-bit hashes of each (place, role, text) up to it, so keys of all prefixes are
running aggregates. Long conversations are numbered and hashed in blocks: rows are dealt by ranges
of (conversation, turn), a window runs inside each block, and totals of earlier blocks are added, so
one conversation may hold a third of all rows.

Subtree totals come in two steps for each level of bands. Within a band of ``height`` depths every
node is exploded to its ancestors in the band only. Roots of the next band then hand their completed
totals to their ancestors in the band above. The roots of all bands form a tree that is ``height``
times flatter, and their totals are found by the same two steps, so both the rounds (the logarithm
of the depth to base ``height``) and the rows of an explosion (``height`` for each node) are bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.llm.frames import cut, materialize, pick, table

#: Depths of a band.
HEIGHT = 8
#: Rows of (conversation, turn) in a block, about.
BLOCK_ROWS = 500_000
NODE = ["depth", "k1", "k2"]


def _least_rows(df: DataFrame, n: int) -> int:
    """Parts that ranges of ``n`` rows are dealt to."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCK_ROWS))


def running(rows: DataFrame, key: str, order: list[str], sums: dict[str, Column], xors: dict[str, Column]) -> DataFrame:
    """``rows`` with running totals (sums) and running exclusive ors over ``order`` within ``key``.

    Rows of one key may be many: they are dealt by ranges of (key, order), and each range starts
    from the totals of those before it. Rows that tie in ``order`` take any order among themselves.
    """
    spark = rows.sparkSession
    n = rows.count()
    dealt = rows.repartitionByRange(_least_rows(rows, n), key, *[F.asc_nulls_first(c) for c in order])
    dealt, _ = materialize(dealt.withColumn("_block", F.spark_partition_id()), "blocks")
    inside = Window.partitionBy("_block", key).orderBy(*[F.asc_nulls_first(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumns({f"_{k}": F.sum(v).over(inside) for k, v in sums.items()} | {f"_{k}": F.bit_xor(v).over(inside) for k, v in xors.items()})
    totals = dealt.groupBy(key, "_block").agg(*[F.sum(v).alias(f"t_{k}") for k, v in sums.items()], *[F.bit_xor(v).alias(f"t_{k}") for k, v in xors.items()])
    starts = totals.select(
        key, "_block",
        *[F.coalesce(F.sum(f"t_{k}").over(before), F.lit(0)).alias(f"s_{k}") for k in sums],
        *[F.coalesce(F.bit_xor(f"t_{k}").over(before), F.lit(0)).alias(f"s_{k}") for k in xors],
    )
    # Only keys that go on in a later block need what came before; all others start from nothing.
    late = " or ".join(f"s_{k} <> 0" for k in [*sums, *xors])
    starts, size = materialize(starts.where(late), "starts", {"n": F.count(F.lit(1))})
    starts = F.broadcast(starts) if size["n"] <= 100_000 else starts
    found = local.join(starts, [key, "_block"], "left")
    zero = F.lit(0)
    return found.select(
        *rows.columns,
        *[(F.col(f"_{k}") + F.coalesce(f"s_{k}", zero)).alias(k) for k in sums],
        *[F.col(f"_{k}").bitwiseXOR(F.coalesce(f"s_{k}", zero)).alias(k) for k in xors],
    )


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn_key, n_bytes) of every turn, numbered from 0 by turn (null first).

    Turns with the same number go by role, then text. Null roles and texts are empty. ``turn_key`` is
    the SHA-256 of role and text, ``n_bytes`` the UTF-8 bytes of the text. Rows without a conv_id are
    no conversation and are left out.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    short = rows.select(F.col("conv_id").cast("long"), "turn", role.alias("role"), F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"), key.alias("turn_key"), text.alias("text"))
    # Texts matter only for the order of turns with one number and role: their first characters and digest decide there.
    tied = short.withColumn("begin", F.substring("text", 1, 64)).drop("text")
    found = running(tied, "conv_id", ["turn", "role", "begin", "digest"], {"number": F.lit(1)}, {})
    return found.select("conv_id", (F.col("number") - 1).cast("long").alias("place"), "turn_key", "n_bytes")


def paths(turns: DataFrame, convs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, n_bytes): the node of every prefix, with its parent's key.

    ``turns`` has (conv_id, place, turn_key, n_bytes), places from 0 on without gaps; ``convs`` all
    conv_ids, of which those without turns are members of the root only.
    """
    depth = (F.col("place") + 1).cast("long")
    tagged = turns.select("conv_id", depth.alias("depth"), "n_bytes", F.xxhash64("turn_key", depth).alias("e1"), F.xxhash64("turn_key", depth, F.lit(7)).alias("e2"))
    keyed = running(tagged, "conv_id", ["depth"], {}, {"k1": F.col("e1"), "k2": F.col("e2")})
    own = keyed.select("conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("e2")).alias("p2"), "n_bytes")
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", *[zero.alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "n_bytes")])
    return own.unionByName(root)


def rolled_up(nodes: DataFrame, steps: DataFrame, height: int, deepest: int) -> DataFrame:
    """(depth, k1, k2, leaves, saved): totals of the subtree of every node.

    ``nodes`` has (depth, k1, k2, conv_id, leaves, saved), where conv_id is a conversation through
    the node; ``steps`` (conv_id, depth, k1, k2) has all nodes on the way of these conversations.
    """
    band = lambda c: F.floor(F.col(c) / height)
    on_way = steps.select("conv_id", band("depth").alias("band"), F.col("depth").alias("at"), F.col("k1").alias("a1"), F.col("k2").alias("a2"))
    # 1. Every node to its ancestors within its band: height rows at most.
    rows = nodes.withColumn("band", band("depth")).join(on_way, ["conv_id", "band"]).where("at <= depth")
    local = rows.groupBy(F.col("at").alias("depth"), F.col("a1").alias("k1"), F.col("a2").alias("k2")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    if deepest < height:
        return local
    local, _ = materialize(local, "band-totals")
    # 2. Band roots are a tree of their own, with a band for each step of depth.
    through = nodes.select(*NODE, "conv_id")
    roots = local.where(F.col("depth") % height == 0).join(through, NODE).withColumn("depth", band("depth"))
    ways = steps.where(F.col("depth") % height == 0).withColumn("depth", band("depth"))
    roots, _ = materialize(roots, "band-roots")
    done = rolled_up(roots, ways, height, deepest // height)
    # 3. Completed totals of band roots to the ancestors in the band above.
    given = done.where("depth > 0").join(roots.select(*NODE, "conv_id"), NODE).withColumn("band", F.col("depth") - 1)
    given = given.select("conv_id", "band", "leaves", "saved").join(on_way, ["conv_id", "band"])
    given = given.select(F.col("at").alias("depth"), F.col("a1").alias("k1"), F.col("a2").alias("k2"), "leaves", "saved")
    return local.unionByName(given).groupBy(*NODE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): SHA-256 of the ascending conv_ids (decimal, comma-joined) that end at a node.

    Ids are sorted and joined by ranges, so a node where a third of all conversations end is spread
    over tasks; what remains for one task is to run the digest over the finished pieces, one at a time.
    """
    n = ends.count()
    ranged = ends.select(*NODE, "conv_id").repartitionByRange(_least_rows(ends, n), *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in NODE), strict=True))
            ids = batch.column("conv_id").to_pylist()
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            out = [(*keys[a], ids[a], ",".join(map(str, ids[a:b]))) for a, b in zip(cuts, cuts[1:]) if b > a]
            yield pa.RecordBatch.from_pydict(dict(zip((*NODE, "first", "joined"), map(list, zip(*out)), strict=True)))

    joined = cut(ranged).mapInArrow(pieces, "depth long, k1 long, k2 long, first long, joined string")
    dealt = joined.repartition(*NODE).sortWithinPartitions(*NODE, "first")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running_digest = None, None
        for batch in batches:
            out: list[tuple] = []
            for *key, text in zip(*(batch.column(c).to_pylist() for c in (*NODE, "joined")), strict=True):
                if key != at:
                    if at is not None:
                        out.append((*at, running_digest.hexdigest()))
                    at, running_digest = key, hashlib.sha256(text.encode())
                else:
                    running_digest.update(b"," + text.encode())
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip((*NODE, "ends_sha256"), map(list, zip(*out)), strict=True)))
        if at is not None:
            yield pa.RecordBatch.from_pydict({**{c: [v] for c, v in zip(NODE, at, strict=True)}, "ends_sha256": [running_digest.hexdigest()]})

    return cut(dealt).mapInArrow(digests, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The nodes of the prefix trie of conversations, with totals of their subtrees.

    Takes numbered ``turns`` (conv_id, place, turn_key, n_bytes) and all ``convs`` (conv_id). Returns conv_id
    (the smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, (n_convs - 1) times the bytes of a node's last text) and ends_sha256.
    An empty table of conversations gives no nodes, not even a root.
    """
    if height < 2:
        raise ValueError("height must be 2 at least")
    members, _ = materialize(paths(turns, convs.distinct()), "members")
    found = members.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("n_bytes").alias("n_bytes")
    )
    children = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = found.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes, seen = materialize(nodes, "nodes", {"deepest": F.max("depth")})
    if seen["deepest"] is None:
        return nodes.selectExpr("conv_id", "depth", "conv_id as parent_conv_id", "n_convs", "n_children", "n_children as n_leaves", "n_bytes as saved_tokens", "'' as ends_sha256")
    own = nodes.select(*NODE, "conv_id", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    # Only the ways of conversations that stand for a node are needed.
    standing = nodes.select("conv_id").distinct()
    steps, _ = materialize(members.select("conv_id", *NODE).join(standing, "conv_id", "left_semi"), "steps")
    totals = rolled_up(own, steps, height, seen["deepest"])
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    last = members.groupBy("conv_id").agg(F.max_by(F.struct(*NODE), "depth").alias("end")).select("conv_id", "end.*")
    with_parent = nodes.join(parents, ["depth", "p1", "p2"], "left")
    out = with_parent.join(totals, NODE).join(end_digests(last), NODE, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Turns of every conversation c after the first h turns of conversation c - c % 5 took the place of its own.

    h is crc32 of the decimal c, modulo 9. Each conversation lends 8 turns at most to 5 others.
    """
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % 9).alias("h")
    wanted = convs.select("conv_id", (c - c % 5).alias("base"), h)
    firsts = turns.where("place < 8").select(F.col("conv_id").alias("base"), "place", "turn_key", "n_bytes")
    lent = wanted.join(firsts, "base").where("place < h").select("conv_id", "place", "turn_key", "n_bytes")
    # Whose first turns are fewer than h closes the gap.
    had = firsts.groupBy("base").agg(F.count(F.lit(1)).alias("had"))
    shift = wanted.join(had, "base", "left").select("conv_id", "h", F.least("h", F.coalesce("had", F.lit(0))).alias("lent"))
    kept = turns.join(shift, "conv_id").where("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("lent")).alias("place"), "turn_key", "n_bytes")
    return lent.unionByName(kept)


def trie_query(spark, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    turns, _ = materialize(numbered(table(spark, sf_dir, "conversations")), "turns")
    convs, _ = materialize(turns.select("conv_id").distinct(), "convs")
    return trie(rebuilt(turns, convs), convs)


#: crc32 over decimal digits: each character, then eight shifts.
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
 lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

TRIE_SQL = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c FROM t),
h AS (SELECT c, c - c % 5 AS base, ({CRC}) % 9 AS h FROM ids),
r AS (SELECT h.c, t.place, role, text FROM h JOIN t ON t.c = h.base AND t.place < h.h
  UNION ALL SELECT h.c, 1000 + t.place, role, text FROM h JOIN t ON t.c = h.c AND t.place >= h.h),
way AS (SELECT c, list((role, text) ORDER BY place) AS turns FROM r GROUP BY c),
full_way AS (SELECT ids.c, coalesce(turns, []) AS turns FROM ids LEFT JOIN way USING (c)),
m AS (SELECT c, unnest(range(len(turns) + 1)) AS depth, turns FROM full_way),
p AS (SELECT c, depth, turns[1:depth] AS path, len(turns) = depth AS ends, CASE WHEN depth > 0 THEN strlen(turns[depth][2]) ELSE 0 END AS n_bytes FROM m),
n AS (SELECT depth, path, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n_bytes) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY depth, path),
kids AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (depth, path)),
up AS (SELECT a.depth, w.path[1:a.depth] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM w, unnest(range(w.depth + 1)) AS a(depth) GROUP BY 1, 2)
SELECT w.conv_id, w.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, w.n_convs, w.n_children::BIGINT AS n_children, up.n_leaves::BIGINT AS n_leaves, up.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM w JOIN up USING (depth, path) LEFT JOIN n AS q ON q.depth = w.depth - 1 AND q.path = w.path[1:w.depth - 1]
"""
