import zlib

import numpy as np
import pytest

from tallygrain.llm import additive, quality


def test_model_learns_single_features_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 4))
    y = ((x[:, 0] > 0.3) | (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = additive.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.93
    assert (1, 2) in model.pairs


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    model = additive.fit(x, (x[:, 0] > 0).astype(float), rounds=10, pair_rounds=3, pairs=2)
    row = x[7]
    total = model.intercept + sum(t[(e <= v).sum()] for t, e, v in zip(model.tables, model.edges, row, strict=True))
    total += sum(t[(ca <= row[a]).sum(), (cb <= row[b]).sum()] for (a, b), (ca, cb), t in zip(model.pairs, model.pair_cuts, model.pair_tables, strict=True))
    assert model.margin(x[7:8])[0] == pytest.approx(total)


def test_without_both_labels_the_score_is_the_smoothed_share():
    assert additive.fit(np.zeros((3, 2)), np.ones(3)).score(np.zeros((1, 2)))[0] == pytest.approx(0.8)
    assert additive.fit(np.zeros((0, 2)), np.zeros(0)).score(np.zeros((1, 2)))[0] == pytest.approx(0.5)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.quality_query(spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows.quality).mean() > 0.9


def test_every_row_is_scored(spark, awkward, texts, nothing):
    labels = spark.createDataFrame([(i, i % 3 and 1, 0) for i in range(20)] + [(None, 1, 0), (4, None, 0), (5, 7, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality.scored(awkward, labels).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        name = "null" if r.doc_id is None else str(r.doc_id)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(name.encode()) % 5 == 0)
    assert quality.scored(nothing, labels).count() == 0
    assert {r.score for r in quality.scored(awkward, labels.limit(0)).collect()} == {0.5}


def test_labels_of_the_held_out_fold_do_not_matter(spark, real, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = [r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    turned = labels.selectExpr("doc_id", f"if(doc_id in ({','.join(map(str, held))}), 1 - quality, quality) as quality", "toxic")
    key = lambda rows: sorted((r.doc_id, r.score) for r in rows)
    assert key(quality.scored(real, labels).collect()) == key(quality.scored(real, turned).collect())


def test_a_document_with_many_rows_is_learnt_from_once(spark, monkeypatch):
    """Only one feature row for each doc_id reaches the driver, however often the document stands in the table."""
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append((x.tolist(), y.tolist())))
    texts = [(i, f"Document {i} has some words. " * (i % 7 + 1)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, quality int")
    once = spark.createDataFrame(texts, "doc_id long, text string")
    often = spark.createDataFrame(texts + texts[:9] * 50, "doc_id long, text string")
    quality.learn(once, labels)
    quality.learn(often, labels)
    assert seen[0] == seen[1] and 20 < len(seen[0][1]) < 40
    other = spark.createDataFrame([(3, "b"), (3, "a"), (3, None)], "doc_id long, text string")
    quality.learn(other, spark.createDataFrame([(3, 1)], "doc_id long, quality int"))
    assert len(seen[2][1]) == 1
