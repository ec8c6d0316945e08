"""Document quality scores from an additive model over counts of characters, words and lines."""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.additive import AdditiveModel, fit
from tallygrain.llm.frames import binary_lists, crc_bucket, per_batch, pick, table

FOLDS = 5
THRESHOLD = 0.3
#: Labelled documents the model is fitted on, at most; those with the smallest hash of their id.
FIT_ROWS = 20_000

FEATURES = [
    "log_chars", "log_words", "log_lines", "word_length", "letters", "digits", "spaces", "other_ascii", "beyond_ascii", "upper",
    "bars", "marks", "stops", "distinct", "repeats", "top_word", "capitals", "odd_ends", "line_repeats", "line_words",
]

LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
UPPER = np.array([65 <= i <= 90 for i in range(256)])
DIGIT = np.array([48 <= i <= 57 for i in range(256)])
SPACE = np.array([i in b" \t\n\r\x0b\x0c" for i in range(256)])
BEYOND = np.arange(256) >= 128
STOPS = np.array([i in b".,;:'\"?-()" for i in range(256)])


def describe(text: bytes) -> list[float]:
    """The features of one whole text; an empty text is all zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = lambda which: float(bytes_[which].sum()) / n
    words, lines = text.split(), text.split(b"\n")
    k = max(1, len(words))
    letters = max(1.0, float(bytes_[LETTER].sum()))
    seen = Counter(words)
    kinds = len(set(lines))
    ends = [w[-1] for w in words]
    odd = sum(1 for e in ends if not (e >= 128 or 48 <= e <= 57 or 65 <= e <= 90 or 97 <= e <= 122 or e in b".,;:'\"?-()"))
    other = share(~(LETTER | DIGIT | SPACE | BEYOND | STOPS))
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), (n - float(bytes_[SPACE].sum())) / k, share(LETTER), share(DIGIT), share(SPACE), other,
        share(BEYOND), float(bytes_[UPPER].sum()) / letters, float(bytes_[124]) / k, float(bytes_[33]) / k, share(STOPS), len(seen) / k,
        sum(map(eq, words, words[1:])) / k, max(seen.values(), default=0) / k, sum(1 for w in words if 65 <= w[0] <= 90) / k, odd / k,
        1 - kinds / len(lines), len(words) / len(lines),
    ]


def _texts(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([describe(t) for t in binary_lists(batch.column("text"))], float).reshape(-1, len(FEATURES))


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> AdditiveModel:
    """A model of ``labels.quality`` from at most ``fit_rows`` labelled rows outside the held-out fold.

    Labels other than 0 and 1 and rows without a doc_id are left out; of several labels for one
    doc_id the smallest counts, of several texts the one with the smallest hash. Only features and labels of that bounded sample reach the driver.
    """
    known = pick(labels, "doc_id", "quality").where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = (
        known.where(crc_bucket("doc_id", FOLDS) != 0).groupBy("doc_id").agg(F.min("quality").cast("long").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    rows = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y", F.xxhash64("doc_id", "text").alias("tie"))
    features = per_batch(
        rows,
        lambda b: {"doc_id": b.column("doc_id"), "tie": b.column("tie"), "y": b.column("y"), "x": pa.array(list(_texts(b)), pa.list_(pa.float64()))},
        f"doc_id {dict(rows.dtypes)['doc_id']}, tie long, y long, x array<double>",
    )
    one = features.groupBy("doc_id").agg(F.min("tie").alias("tie"), F.min_by(F.struct("y", "x"), "tie").alias("r"))
    sample = one.select("tie", "r.y", "r.x").toArrow().sort_by("tie")
    x = np.array(sample.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, np.array(sample.column("y").to_pylist(), float))


def scored(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, *others: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score (0 to 1), predicted, and ``others``.

    Null and empty texts are scored like any other. Empty tables give no rows.
    """
    model = learn(docs, labels, fit_rows)

    def rows(batch: pa.RecordBatch) -> dict:
        return {n: batch.column(n) for n in ["doc_id", "held_out", *others]} | {"score": model.score(_texts(batch))}

    taken = pick(docs, *dict.fromkeys(["doc_id", "text", *others])).withColumn("held_out", crc_bucket("doc_id", FOLDS) == 0)
    kinds = dict(taken.dtypes)
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in ["doc_id", "held_out", *others]) + ", score double"
    return per_batch(taken, rows, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality_query(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
