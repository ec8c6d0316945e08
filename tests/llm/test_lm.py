import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tallygrain.llm import bilinear, lm_score, vocabularies


def test_table_probabilities_are_the_normalised_model():
    rng = np.random.default_rng(0)
    model = bilinear.start(rng.integers(1, 50, 40).astype(float))
    model = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in model.items()}
    look = bilinear.tables(model)
    v, u = np.divmod(np.arange(1600), 40)
    total = np.zeros(1600)
    for w in range(40):
        total += np.exp(bilinear.log_probabilities(look, v, u, np.full(1600, w)))
    assert np.allclose(total, 1, atol=1e-4)
    h = model["a"][3] + model["b"][5]
    s = model["q"] @ h + model["bias"]
    assert bilinear.log_probabilities(look, np.array([3]), np.array([5]), np.array([7]))[0] == pytest.approx(s[7] - np.log(np.exp(s).sum()), abs=1e-4)


def test_training_learns_from_context():
    rng = np.random.default_rng(1)
    ids = np.zeros(60_000, np.int64)
    for i in range(1, len(ids)):
        ids[i] = (ids[i - 1] + 1) % 20 if rng.random() < 0.9 else rng.integers(20)
    counts = np.bincount(ids, minlength=20).astype(float)
    trainer = bilinear.Trainer(bilinear.start(counts), counts, 3)
    v, u = lm_score.contexts(ids, np.array([0]))
    trainer.learn(v, u, ids)
    trainer.learn(v, u, ids)
    assert bilinear.log_probabilities(bilinear.tables(trainer.m), v, u, ids).mean() > -1.5 > math.log(1 / 20)


def brute(rows):
    """Base scores by counting all tokens; rows are (id, text)."""
    tokens = [(i, [*(t or "").encode().lower().split(), b""]) for i, t in rows]
    fold = lambda i: zlib.crc32(("null" if i is None else str(i)).encode()) % 10
    counts = Counter(w for i, ws in tokens if fold(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, ws in tokens:
        out.append((fold(i) == 0, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)))
    return out


@pytest.mark.parametrize("frequent", [1 << 17, 40])
def test_base_scores(awkward, texts, monkeypatch, frequent):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    monkeypatch.setattr(lm_score, "OWN", 30)
    rows = lm_score.scored(awkward).collect()
    ids = [i if i != 3 else None for i in range(len(texts))]
    want = sorted(brute([*zip(ids, texts, strict=True), (15, texts[15])]))
    got = sorted((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want])
    assert all(r.score < 0 for r in rows)


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = lm_score.lm_query(spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    assert rows.score.sum() > rows.base_score.sum()


def test_counts_do_not_depend_on_how_often_they_are_handed_on(real, monkeypatch):
    whole = {bytes(r.word): r.c for r in lm_score.word_counts(real).collect()}
    monkeypatch.setattr(lm_score, "HELD_WORDS", 50)
    assert {bytes(r.word): r.c for r in lm_score.word_counts(real).collect()} == whole


def test_repeated_rows_are_learnt_from_once_at_the_start(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "START_DOCS", 3)
    rows = [(1, "one two three")] * 200 + [(i, f"four five {i}") for i in range(2, 6)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_score.train(docs, lm_score.vocabulary(lm_score.word_counts(docs)))
    assert all(np.isfinite(v).all() for v in model.values())


def test_a_worker_holds_one_model():
    made = []
    for name in ("a", "a", "b", "a"):
        assert vocabularies.latest("test of models", name, lambda name=name: made.append(name) or name) == name
    assert made == ["a", "b", "a"]


def test_probabilities_of_all_next_words_sum_to_one(spark, real):
    counts = lm_score.word_counts(real)
    words = lm_score.vocabulary(counts)
    mass = Counter()
    for r in counts.collect():
        mass[words.symbol(bytes(r.word))] += r.c + 0.1
    for k in range(words.first_class, len(words.weights)):
        assert mass[k] + 0.1 == pytest.approx(words.weights[k])  # a class holds its words and one unseen word


def test_empty_and_untrained(spark, nothing):
    assert lm_score.scored(nothing).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = lm_score.scored(spark.createDataFrame([(held, "some words")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
