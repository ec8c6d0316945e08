"""From raw documents to packed training sequences: quality, near copies, repeats, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as
the docs of the next; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallygrain.llm.frames import materialize, pick, table
from tallygrain.llm.neardup import one_of_each
from tallygrain.llm.packing import pack
from tallygrain.llm.quality import FIT_ROWS, scored
from tallygrain.llm.suffix_dedup import without_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes of a passage that is removed where it repeats: some 50 words of mostly short words.
PASSAGE_BYTES = 256


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    marked = scored(docs, table(spark, sf_dir, "labels"), FIT_ROWS, "text", "lang", "source", "n_chars")
    return marked.where("predicted = 1").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies (five-word shingles, 0.8)."""
    return one_of_each(pick(docs, *COLUMNS))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat, cut at whole characters; n_chars follows the text."""
    return without_repeats(pick(docs, *COLUMNS), PASSAGE_BYTES).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens, with their token ids."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("repeated passages", repeats_stage),
    ("packing", packing_stage),
]

#: The model, the sketches and the tokenizer have no form in SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
