import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallygrain.llm import graph, neardup, simhash
from tallygrain.llm.frames import pick


def brute_print(text, size):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprints(awkward, texts):
    rows = simhash.fingerprints(awkward).collect()
    want = sorted([brute_print(t, 3) for t in texts] + [brute_print(texts[15], 3)])
    assert sorted(r.fp % (1 << 64) for r in rows) == want


def test_counts_bound_the_distance(spark):
    rng = np.random.default_rng(2)
    values = [int(v) for v in rng.integers(-(1 << 63), (1 << 63) - 1, 60)] + [0, -1, (1 << 63) - 1, -(1 << 63)]
    rows = spark.createDataFrame([(a, b) for a, b in itertools.combinations(values, 2)], "a long, b long")
    near = simhash.manhattan(simhash.segment_counts(F.col("a")), simhash.segment_counts(F.col("b")))
    for r in rows.select("a", "b", near.alias("d")).collect():
        points = [[(v >> i & 1) + (v >> i + 1 & 1) for i in range(0, 64, 2)] for v in (r.a % (1 << 64), r.b % (1 << 64))]
        assert r.d == sum(abs(x - y) for x, y in zip(*points, strict=True)) <= ((r.a ^ r.b) % (1 << 64)).bit_count()


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_are_those_of_all_pairs(spark, radius):
    rng = np.random.default_rng(radius)
    base = [int(v) for v in rng.integers(0, 1 << 63, 20, dtype=np.uint64)] + [0, (1 << 64) - 1]
    values = set(base)
    for v in base:
        for _ in range(12):
            w = v
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                w ^= 1 << int(bit)
            values.add(w)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {tuple(sorted((r.x, r.y))) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius).collect()}
    want = {tuple(sorted(p)) for p in itertools.combinations(signed, 2) if ((p[0] ^ p[1]) % (1 << 64)).bit_count() <= radius}
    assert got == want
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)


def test_components_of_chains_stars_and_cycles(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(300, 301), (301, 302), (302, 300), (7, 7), (301, 300)]
    nodes = {x for p in pairs for x in p if p[0] != p[1]}
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == roots(nodes, [p for p in pairs if p[0] != p[1]])
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_match_all_pairs(spark, sf_dir, real, nothing):
    rows = simhash.simhash_query(spark, sf_dir).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    near = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {r.doc_id: r.component_id for r in rows} == roots(prints, near)
    assert simhash.groups(simhash.fingerprints(nothing)).count() == 0


def test_groups_of_awkward_rows(awkward, texts):
    rows = simhash.groups(simhash.fingerprints(awkward)).collect()
    assert len(rows) == len(texts) + 1
    empty = {r.component_id for r in rows if r.fp == 0}
    assert empty == {0}  # null and empty texts are one group
    assert {r.component_id for r in rows if r.doc_id in (12, 42, 43)} == {12}  # copies


def shingle_set(text, size=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_kept(rows):
    """Ids that stay, by all pairs of shingle sets."""
    sets = {i: shingle_set(t) for i, t in rows.items()}
    near = []
    for a, b in itertools.combinations(sorted(rows), 2):
        common = len(sets[a] & sets[b])
        if (rows[a] or "") == (rows[b] or "") or common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
            near.append((a, b))
    return set(roots(rows, near).values())


def test_one_of_each_matches_all_pairs(real):
    rows = {r.doc_id: r.text for r in real.collect()}
    assert {r.doc_id for r in neardup.one_of_each(real).collect()} == brute_kept(rows)


def test_one_of_each_on_awkward_rows(awkward, texts, nothing):
    kept = neardup.one_of_each(pick(awkward, "doc_id", "text", "lang", "source", "n_chars"))
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and None in ids  # the repeated row is gone, the row without id stays
    assert set(ids) - {None} == brute_kept({i: t for i, t in enumerate(texts) if i != 3})
    assert neardup.one_of_each(nothing).count() == 0


def test_a_large_group_of_near_copies_becomes_one(spark):
    rng = random.Random(8)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    copies = []
    for i in range(400):
        mine = list(words)
        mine[rng.randrange(200)] = f"x{i}"
        copies.append((i, " ".join(mine)))
    others = [(1000 + i, " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(100))) for i in range(20)]
    docs = spark.createDataFrame(copies + others, "doc_id long, text string")
    assert sorted(r.doc_id for r in neardup.one_of_each(docs).collect()) == [0, *range(1000, 1020)]


def test_a_star_of_copies_edited_apart_becomes_one(spark):
    """Each copy is near the original (0.8 or more) and, mostly, near no other copy."""
    rng = random.Random(9)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(250)]
    copies = [(0, " ".join(words))]
    for i in range(1, 2501):
        mine = list(words)
        for at in rng.sample(range(8, 242), 4):
            mine[at] = f"x{i}y{at}"
        copies.append((i, " ".join(mine)))
    others = [(5000 + i, " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(100))) for i in range(20)]
    docs = spark.createDataFrame(copies + others, "doc_id long, text string")
    assert sorted(r.doc_id for r in neardup.one_of_each(docs).collect()) == [0, *range(5000, 5020)]


def test_short_texts_with_an_edit_at_the_end_match_all_pairs(spark):
    rng = random.Random(10)
    rows = {}
    for i in range(300):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(10, 60))]
        changed = [*words[:-1], f"x{i}"] if i % 2 else [*words, f"y{i}", f"z{i}"]
        rows |= {2 * i: " ".join(words), 2 * i + 1: " ".join(changed)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    want = brute_kept(rows)
    assert len(want) < 500
    assert {r.doc_id for r in neardup.one_of_each(docs).collect()} == want


def test_parities_differ_in_no_more_bits_than_shingles():
    rng = np.random.default_rng(12)
    for n in (1, 30, 900, 5000):
        common, a, b = (rng.integers(0, 1 << 64, k, dtype=np.uint64) for k in (n, n // 5 + 1, n // 7))
        x, y = neardup.parities(np.concatenate([common, a])), neardup.parities(np.concatenate([b, common]))
        turned = sum((int(i) ^ int(j)).bit_count() for i, j in zip(np.array(x).view(np.uint64), np.array(y).view(np.uint64), strict=True))
        assert len(x) == neardup.WORDS and turned <= len(a) + len(b)


def test_texts_of_shared_passages_match_all_pairs(spark):
    """Texts made of the same passages in other mixtures: many candidates, similarities on both sides of 0.8."""
    rng = random.Random(13)
    passages = [[f"p{rng.randint(0, 10**6)}" for _ in range(60)] for _ in range(8)]
    rows = {}
    for i in range(250):
        words = [w for p in rng.sample(passages, 5) for w in p]
        if rng.random() < 0.5:
            words = [w for p in passages[:5] for w in p]
        for at in rng.sample(range(len(words)), rng.randint(0, 14)):
            words[at] = f"x{i}y{at}"
        rows[i] = " ".join([*words, *(f"o{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 40)))])
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    want = brute_kept(rows)
    assert 100 < len(want) < 250
    assert {r.doc_id for r in neardup.one_of_each(docs).collect()} == want


def test_rows_without_id_pass_links_on(spark):
    # 0, 11 and 1111 are 2 bits apart one by one; the one in the middle has no id.
    rows = [(5, 0b00000), (None, 0b00011), (9, 0b01111), (None, 0b11111 << 40), (None, 0b111111 << 40)]
    got = sorted((r.doc_id or -1, r.fp, r.component_id) for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, fp long"), 2).collect())
    assert got == sorted([(5, 0, 5), (-1, 3, 5), (9, 15, 5), (-1, 0b11111 << 40, None), (-1, 0b111111 << 40, None)], key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("small", [0, neardup.SMALL])
def test_near_copies_come_from_the_fingerprints_first(spark, monkeypatch, small):
    """Copies edited at an end lie in the grid's reach; what the fingerprints link isn't joined on shingles again."""
    rng = random.Random(14)
    rows = {}
    for i in range(60):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
        rows |= {3 * i: " ".join(words), 3 * i + 1: " ".join([*words[:-1], f"x{i}"]), 3 * i + 2: " ".join([*words[:150], *(f"z{i}y{k}" for k in range(30)), *words[180:]])}
    asked = []

    def noted(pairs, *others, verified=neardup.verified):
        good = verified(pairs, *others)
        asked.append(({tuple(r) for r in pairs.select("a", "b").collect()}, {tuple(r) for r in good.collect()}))
        return good

    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "verified", noted)
    texts = spark.createDataFrame(list(rows.items()), "id long, text string")
    found = {r.node: r.component for r in neardup.near_duplicate_groups(texts).collect()}
    prints = {i: brute_print(t, 3) for i, t in rows.items()}
    first = {fp: min(i for i in rows if prints[i] == fp) for fp in prints.values()}
    close = {p for p in itertools.combinations(sorted(first.values()), 2) if (prints[p[0]] ^ prints[p[1]]).bit_count() <= 2}
    close |= {(first[fp], i) for i, fp in prints.items() if first[fp] != i}
    assert asked[0][0] == close and len(asked[0][1]) >= 20
    assert not any(asked[0][1] & more for more, _ in asked[1:])
    assert any(good for _, good in asked[1:])
    sets = {i: shingle_set(t) for i, t in rows.items()}
    near = [(a, b) for a, b in itertools.combinations(sorted(rows), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert found == roots({x for p in near for x in p}, near)


def test_close_prints_stand_against_one_text_of_a_fingerprint(spark):
    words = " ".join(f"w{k}" for k in range(300))
    rows = [(0, words), (1, words.upper()), (2, words.replace(" ", "\n")), (3, " \n"), (4, "other words here"), (5, "\t")]
    got = {tuple(r) for r in neardup.close_prints(spark.createDataFrame(rows, "id long, text string")).collect()}
    assert got == {(0, 1), (0, 2), (3, 5)}
    assert {r.doc_id for r in neardup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0, 3, 4, 5}
