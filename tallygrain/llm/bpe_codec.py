"""Documents encoded and decoded by trie BPE, batch by batch."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.frames import per_batch, pick, table
from tallygrain.llm.trie_bpe import TrieBpe
from tallygrain.llm.vocabularies import held, public_path


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>, decoded) for each row of ``docs``; null texts are empty and have no ids."""
    path = path or public_path("word_bpe_49k.json")

    def rows(batch: pa.RecordBatch) -> dict:
        found = held(f"trie {path}", lambda: TrieBpe(path)).encode_batch([t or "" for t in batch.column("text").to_pylist()])
        return {
            "doc_id": batch.column("doc_id"),
            "ids": pa.array([list(map(int, ids.split())) for ids, _ in found], pa.list_(pa.int32())),
            "decoded": [text for _, text in found],
        }

    return per_batch(pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")), rows, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): as ``encoded``, without moving ids and texts out of the task."""
    path = path or public_path("word_bpe_49k.json")

    def rows(batch: pa.RecordBatch) -> dict:
        found = held(f"trie {path}", lambda: TrieBpe(path)).encode_batch([t or "" for t in batch.column("text").to_pylist()])
        return {
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array([ids.count(" ") + 1 if ids else 0 for ids, _ in found], pa.int64()),
            "ids_sha256": [hashlib.sha256(ids.encode()).hexdigest() for ids, _ in found],
            "decoded_sha256": [hashlib.sha256(text.encode()).hexdigest() for _, text in found],
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return per_batch(pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")), rows, schema)


def bpe_query(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
