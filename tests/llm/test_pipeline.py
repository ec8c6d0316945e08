import zlib
from collections import Counter

import corpus_pipeline
import __spark_entry__
from tallygrain.llm.frames import pick

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered_queries(spark, sf_dir):
    names = list(__spark_entry__.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_stages_on_real_rows(spark, sf_dir, real):
    docs = real
    kept = {r.doc_id: r.text for r in real.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), real.schema)
        rows = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == COLUMNS and set(rows) <= set(kept)
        assert all(r.n_chars == len(r.text) for r in docs.collect())
        if name != "repeated passages":
            assert all(kept[i] == t for i, t in rows.items())
            assert len(rows) < len(kept)
        else:
            assert set(rows) == set(kept)
            left = Counter(b[i : i + 256] for b in (t.encode() for t in kept.values()) for i in range(len(b) - 255))
            for i, t in rows.items():
                b = kept[i].encode()
                repeated = any(left[b[j : j + 256]] > 1 for j in range(len(b) - 255))
                assert (t != kept[i]) == repeated
        kept = rows
    pieces = corpus_pipeline.packing_stage(spark, docs, sf_dir).collect()
    assert {p.doc_id for p in pieces} == set(kept)


def test_good_documents_stay(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, folder).collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    good, bad = [i for i in held if labels[i]], [i for i in held if not labels[i]]
    assert sum(i in kept for i in good) >= 0.98 * len(good) and sum(i in kept for i in bad) <= 0.4 * len(bad)


def test_stages_on_awkward_and_empty_rows(spark, sf_dir, awkward, nothing, texts):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0
        assert stage(spark, awkward, sf_dir).count() > 0
    kept = corpus_pipeline.repeats_stage(spark, awkward, sf_dir)
    assert kept.count() == len(texts) + 1 and kept.columns == COLUMNS
    assert pick(kept, "n_chars").where("n_chars is null").count() == 0


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    lengths = Counter()
    for r in rows:
        lengths[r.sequence_id] += r.length
    assert rows and max(lengths.values()) <= 2048
