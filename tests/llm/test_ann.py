import numpy as np
import pytest

from tallygrain.llm import ann, routing


def brute(rows, k, query):
    """rows: (id, vector) that take part; the k nearest of each query id."""
    out = {}
    for q in query:
        mine = [v for i, v in rows if i == q][0]
        scored = sorted(((-float(np.dot(np.array(v, float), np.array(mine, float))), i) for i, v in rows if i != q))
        out[q] = [i for _, i in scored[:k]]
    return out


def test_small_tables_are_searched_exactly_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=8), 1)]) for i in range(0, 60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)]  # copies of one vector
    odd = [(200, None), (220, [0.0] * 8), (240, [float("nan")] + [1.0] * 7), (260, [None] + [1.0] * 7), (280, [float("inf")] + [1.0] * 7), (300, [1.0, 2.0]), (None, [1.0] * 8)]
    frame = spark.createDataFrame(rows + odd + [rows[5]], "vec_id long, embedding array<float>").selectExpr("*", "1 as part", "2 as score", "3 as v")
    got = {}
    for r in ann.search(frame, frame.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    want = brute(rows, 20, [0, 20, 40, 100, 120])
    assert sorted(got) == sorted(want)
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [i for _, i, _ in found] == want[q]


def test_fewer_vectors_than_asked(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (7, [0.0, 1.0])], "vec_id long, embedding array<float>")
    rows = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(frame, frame.where("vec_id % 20 = 0"), 20).collect())
    assert rows == [(0, 1, 20, 0.5), (0, 2, 7, 0.0), (20, 1, 0, 0.5), (20, 2, 7, 0.5)]
    assert ann.search(frame.limit(0), frame.limit(0), 20).count() == 0


def test_recall_on_the_given_vectors(spark):
    for folder in ("sf0.01", "sf0.1"):
        vectors = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
        rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
        found = {}
        for r in ann.ann_query(spark, f"/root/testdata/{folder}").collect():
            found.setdefault(r.query_id, set()).add(r.vec_id)
        want = brute(rows, 20, [i for i, _ in rows if i % 20 == 0])
        assert sum(len(found[q] & set(w)) for q, w in want.items()) / sum(map(len, want.values())) >= 0.9


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16))
    x = np.concatenate([c + 0.2 * rng.normal(size=(100, 16)) for c in centres])
    near = routing.nearest(x, x, 10, skip_self=True)
    part = routing.balanced_parts(near, 8)
    assert np.bincount(part, minlength=8).max() <= 110
    assert (part[near] == part[:, None]).mean() > 0.7
    router = routing.fit_router(rng.permutation(x), 8, 10, 0.95)
    assert 1 <= router.probes <= 8
    assert routing.fit_router(x[:5], 8, 10, 0.95).probes == 1


@pytest.mark.parametrize("block", [16])
def test_blocks_and_query_folds_change_nothing(spark, monkeypatch, block):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    key = lambda: sorted(tuple(r) for r in ann.search(vectors, vectors.where("vec_id % 20 = 0"), 20).collect())
    whole = key()
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 4)
    assert key() == whole
