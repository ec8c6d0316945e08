import random

import pytest

from tallygrain.llm import jaccard_join
from tallygrain.llm.frames import pick

SCHEMA = "doc_id long, text string"


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(rows, size, percent):
    """Component of every row by comparing all pairs."""
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(s), (least.get(find(i)) if s else doc)) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**9)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    """Stars of copies edited on their own, chains, a passage that most texts share, short texts, repeats."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(4000)}"
    texts = []
    for words in (200, 60, 30):
        origin = [word() for _ in range(words)]
        texts += [edited(rng, origin, rng.randrange(0, max(2, words // 25) * 2)) for _ in range(60)]
    chain = [word() for _ in range(150)]
    for _ in range(25):
        chain = edited(rng, chain, 2).split()
        texts.append(" ".join(chain))
    passage = " ".join(word() for _ in range(80))
    texts += [passage + " " + " ".join(word() for _ in range(rng.randrange(0, 60))) for _ in range(60)]
    texts += [" ".join(rng.sample("a b c d e f".split(), rng.randint(1, 5))) for _ in range(40)]
    texts += [texts[0], texts[0].upper(), texts[0].replace(" ", "\n"), "", None, "  "]
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, percent", [(4, 85), (4, 60), (2, 100)])
@pytest.mark.parametrize("few", [0, 512])
def test_against_all_pairs(spark, corpus, monkeypatch, size, percent, few):
    monkeypatch.setattr(jaccard_join, "FEW", few)
    frame = spark.createDataFrame(corpus, SCHEMA).repartition(5)
    got = [tuple(r) for r in jaccard_join.jaccard_groups(frame, size, percent).collect()]
    assert ordered(got) == ordered(brute(corpus, size, percent))


def test_frequent_shingles_travel_as_counts(spark, corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 2)
    got = [tuple(r) for r in jaccard_join.jaccard_groups(spark.createDataFrame(corpus, SCHEMA)).collect()]
    assert ordered(got) == ordered(brute(corpus, 4, 85))


def test_awkward_rows(spark, awkward):
    rows = [(r.doc_id, r.text) for r in pick(awkward, "doc_id", "text").collect()]
    assert ordered(tuple(r) for r in jaccard_join.jaccard_groups(awkward).collect()) == ordered(brute(rows, 4, 85))


def test_empty_table_and_bad_percent(spark, nothing):
    assert jaccard_join.jaccard_groups(nothing).collect() == []
    with pytest.raises(ValueError):
        jaccard_join.jaccard_groups(nothing, 4, 0)
