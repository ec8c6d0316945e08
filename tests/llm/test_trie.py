import hashlib
import random
import zlib

import pytest

from tallygrain.llm import prefix_trie
from tallygrain.llm.frames import materialize

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(ways):
    """Node rows of {conv_id: [(role, text), ...]}."""
    nodes = {}
    for c, way in ways.items():
        for d in range(len(way) + 1):
            nodes.setdefault(tuple(way[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = sum(not any(q[:-1] == p for q in nodes if q) for p in below)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if len(ways[c]) == len(path))))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def ordered(rows):
    return sorted(tuple(r) for r in [[x if x is not None else -1 for x in r] for r in rows])


def in_order(rows):
    ways = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        ways.setdefault(c, []).append((role or "", text or ""))
    return ways


def changed(ways):
    out = {}
    for c, way in ways.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = ways.get(c - c % 5, [])[:h] + way[h:]
    return out


@pytest.fixture(scope="module")
def talks():
    """Shared first turns, a long conversation, copies, gaps, repeated rows, nulls everywhere."""
    rng = random.Random(2)
    rows = []
    for c in range(60):
        n = rng.choice([1, 2, 3, 5, 9, 14]) if c != 31 else 70
        for t in range(n):
            text = rng.choice(["yes", "no", "é and more", None, ""]) if rng.random() < 0.5 else "same"
            rows.append((c, t if t != 1 or c % 7 else None, rng.choice(["user", None, "assistant"]) if t > 4 else "user", text))
    rows += [(c, t, r, x) for c in (100, 101, 102) for _, t, r, x in [x for x in rows if x[0] == 31]]
    rows += rows[:3] + [(None, 0, "user", "nobody"), (205, 0, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [2, 3, 8, 100])
def test_trie_against_all_prefixes(spark, talks, height):
    turns, _ = materialize(prefix_trie.numbered(spark.createDataFrame(talks, SCHEMA)), "turns")
    got = prefix_trie.trie(turns, turns.select("conv_id"), height).collect()
    assert ordered(got) == ordered(brute(in_order(talks)))


def test_rebuilt_conversations(spark, talks, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", 20)  # conversations go across blocks
    turns, _ = materialize(prefix_trie.numbered(spark.createDataFrame(talks, SCHEMA)), "turns")
    convs = turns.select("conv_id").distinct()
    got = prefix_trie.trie(prefix_trie.rebuilt(turns, convs), convs).collect()
    assert ordered(got) == ordered(brute(changed(in_order(talks))))


def test_turnless_conversation_is_a_member_of_the_root(spark):
    # Conversation 7 takes all its turns from 5, which has none.
    h = zlib.crc32(b"7") % 9
    rows = [(7, t, "user", f"t{t}") for t in range(h)]
    assert h
    turns, _ = materialize(prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA)), "turns")
    convs = turns.select("conv_id").distinct()
    (root,) = prefix_trie.trie(prefix_trie.rebuilt(turns, convs), convs).collect()
    assert tuple(root) == (7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())


def test_empty_table_and_clashing_columns(spark, talks):
    assert prefix_trie.trie(*[prefix_trie.numbered(spark.createDataFrame([], SCHEMA))] * 2).collect() == []
    frame = spark.createDataFrame(talks, SCHEMA).selectExpr("*", "'x' as number", "1 as place", "'y' as TEXT", "2 as depth", "3 as digest")
    turns, _ = materialize(prefix_trie.numbered(frame), "turns")
    assert ordered(prefix_trie.trie(turns, turns.select("conv_id")).collect()) == ordered(brute(in_order(talks)))


def test_bad_height(spark):
    with pytest.raises(ValueError):
        prefix_trie.trie(None, None, 1)
