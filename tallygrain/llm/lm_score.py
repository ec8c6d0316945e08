"""Log-probabilities of texts under a corpus unigram and a log-bilinear model.

Counts of words cover all training documents. The most frequent words, a bounded number, travel to
every task; what depends on the count of any other word is joined, so the vocabulary may grow with
the corpus. The log-bilinear model predicts symbols: the most frequent words, the end, and classes
of the other words by their last two bytes; within a class a word has its smoothed share. Each task
trains on its own documents from a common start, and the parameters are averaged by the number of
tokens seen, so training covers the whole training part in one pass.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm import bilinear
from tallygrain.llm.frames import binary_lists, crc_bucket, cut, materialize, per_batch, pick, table
from tallygrain.llm.vocabularies import latest

FOLDS = 10
SMOOTH = 0.1
END = b""  # no word is empty
#: Words that travel to every task (none longer than 64 bytes), symbols of the model, classes.
FREQUENT, OWN, CLASSES = 1 << 17, 1023, 512
#: Documents of the sample that the common start is trained on.
START_DOCS = 1500
#: Words whose counts a task holds before it hands them on.
HELD_WORDS = 100_000


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, c) over all words and ends of ``docs``, counted within tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "c": pa.array(list(seen.values()), pa.int64())})

        for batch in batches:
            for text in binary_lists(batch.column("text")):
                seen.update(text.lower().split())
            seen[END] += batch.num_rows
            if len(seen) > HELD_WORDS:
                yield out()
                seen.clear()
        if seen:
            yield out()

    return cut(docs.select("text")).mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """The frequent words with counts, the symbols, and the totals; of bounded size."""

    def __init__(self, frequent: list[tuple[bytes, int]], own: list[bytes], class_mass: dict[int, tuple[int, int]], tokens: int, types: int):
        self.tokens, self.types = tokens, types
        self.counts = dict(frequent)
        self.symbols = {w: i for i, w in enumerate([END, *own])}
        self.first_class = len(self.symbols)
        mass = [class_mass.get(i, (0, 0)) for i in range(CLASSES)]
        self.class_mass = np.array([c + SMOOTH * (v + 1) for c, v in mass])
        self.weights = np.concatenate([[self.counts.get(w, 0) + SMOOTH for w in self.symbols], self.class_mass])

    @classmethod
    def of(cls, state: dict) -> Vocabulary:
        """From the attributes of another; broadcasts carry plain values only."""
        found = cls.__new__(cls)
        found.__dict__.update(state)
        return found

    def symbol(self, word: bytes) -> int:
        found = self.symbols.get(word)
        return self.first_class + zlib.crc32(word[-2:]) % CLASSES if found is None else found

    def lookup(self) -> dict[bytes, int]:
        """Symbols of all frequent words, for whole lists of words at once."""
        return {w: self.symbol(w) for w in self.counts} | self.symbols

    def encode(self, texts: list[bytes], known: dict[bytes, int]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
        """Words of each text with the end, all symbols, and where each text begins."""
        words = [[*t.lower().split(), END] for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.fromiter(map(known.get, chain.from_iterable(words), repeat(-1)), np.int64, int(sizes.sum()))
        flat = list(chain.from_iterable(words)) if (ids < 0).any() else []
        for i in np.flatnonzero(ids < 0).tolist():
            ids[i] = self.symbol(flat[i])
        return words, ids, np.cumsum(sizes) - sizes


def contexts(ids: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbol before each and the one before that; before a text stand ends (symbol 0)."""
    v = np.concatenate([[0], ids[:-1]])
    v[begins] = 0
    u = np.concatenate([[0], v[:-1]])
    u[begins] = 0
    return v, u


def vocabulary(counts: DataFrame) -> Vocabulary:
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("c").alias("v")).first()
    top = counts.where("length(word) <= 64").orderBy(F.desc("c"), "word").limit(FREQUENT).toArrow()
    frequent = list(zip(top.column("word").to_pylist(), top.column("c").to_pylist(), strict=True))
    own = [w for w, _ in frequent if w != END][:OWN]
    names = counts.sparkSession.createDataFrame([(bytearray(w),) for w in [*own, END]], "word binary")
    others = counts.join(F.broadcast(names), "word", "left_anti")
    of = F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(CLASSES)).cast("int")
    mass = {r["k"]: (r["c"], r["v"]) for r in others.groupBy(of.alias("k")).agg(F.sum("c").alias("c"), F.count("c").alias("v")).collect()}
    return Vocabulary(frequent, own, mass, totals["n"], totals["v"])


def train(docs: DataFrame, words: Vocabulary) -> dict[str, np.ndarray]:
    """The averaged model; ``docs`` are the training documents."""
    spark = docs.sparkSession
    model = bilinear.start(words.weights)
    # Only hashes are sorted; repeated rows are taken once.
    hashed = docs.select("text", F.xxhash64("doc_id", "text").alias("h"))
    last = hashed.select("h").distinct().orderBy("h").limit(START_DOCS).agg(F.max("h")).first()[0]
    if last is None:
        return model
    sample = hashed.where(F.col("h") <= last).groupBy("h").agg(F.first("text").alias("text")).orderBy("h").select("text").toArrow()
    _, ids, begins = words.encode(binary_lists(sample.column("text").combine_chunks()), words.lookup())
    first = bilinear.Trainer(model, words.weights, 1)
    for _ in range(2):
        first.learn(*contexts(ids, begins), ids)
    model = first.m
    shared = spark.sparkContext.broadcast((vars(words), model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, model = shared.value
        words = Vocabulary.of(state)
        trainer, known = None, None
        for batch in batches:
            if trainer is None:
                trainer, known = bilinear.Trainer(model, words.weights, 2, rate=0.03), words.lookup()
            _, ids, begins = words.encode(binary_lists(batch.column("text")), known)
            trainer.learn(*contexts(ids, begins), ids)
        if trainer and trainer.seen:
            for name, values in trainer.m.items():
                values = values.reshape(len(values), -1) * trainer.seen
                yield pa.RecordBatch.from_pydict({
                    "name": [name] * len(values),
                    "at": np.arange(len(values), dtype=np.int32),
                    "weight": np.full(len(values), trainer.seen, np.int64),
                    "v": pa.array(list(values.astype(np.float64)), pa.list_(pa.float64())),
                })

    parts = cut(docs.select("text")).mapInArrow(run, "name string, at int, weight long, v array<double>")
    sums = [F.coalesce(F.sum(F.get("v", F.lit(i))), F.lit(0.0)) for i in range(bilinear.WIDTH)]
    mean = parts.groupBy("name", "at").agg(F.sum("weight").alias("weight"), F.array(*sums).alias("v")).toArrow()
    out = {k: v.copy() for k, v in model.items()}
    if mean.num_rows:
        names, at = np.array(mean.column("name").to_pylist()), mean.column("at").to_numpy()
        values = np.array(mean.column("v").to_pylist()) / mean.column("weight").to_numpy()[:, None]
        for name, table_ in out.items():
            here = names == name
            table_[at[here]] = values[here][:, 0] if table_.ndim == 1 else values[here]
    return out


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``.

    Logarithms are to the base 10. Null texts are empty, and an empty text is its end alone.
    Documents whose fold is 0 are scored like all others but not learnt from; null ids fall in the
    fold of the text 'null'. Without any training document every token counts as new.
    """
    docs = pick(docs, "doc_id", "text").withColumn("held_out", crc_bucket("doc_id", FOLDS) == 0)
    learnt = docs.where("not held_out")
    counts, _ = materialize(word_counts(learnt), "word-counts")
    words = vocabulary(counts)
    model = train(learnt, words)
    shared = docs.sparkSession.sparkContext.broadcast((vars(words), model))
    name = hashlib.md5(b"".join(v.tobytes() for v in model.values())).hexdigest()
    base = float(np.log10(words.tokens + SMOOTH * (words.types + 1)))

    def rows(batch: pa.RecordBatch) -> dict:
        state, model = shared.value
        words = Vocabulary.of(state)

        def tools():
            logs = {w: float(np.log10(c + SMOOTH)) for w, c in words.counts.items()}
            shift = np.zeros(len(words.weights))
            shift[words.first_class :] = np.log10(words.class_mass)
            return words.lookup(), logs, bilinear.tables(model), shift

        known, logs, look, shift = latest("lm", name, tools)
        texts, ids, begins = words.encode(binary_lists(batch.column("text")), known)
        v, u = contexts(ids, begins)
        n = np.diff(np.concatenate([begins, [len(ids)]]))
        symbol = bilinear.log_probabilities(look, v, u, ids) / np.log(10) - shift[ids]
        flat = np.fromiter(map(logs.get, chain.from_iterable(texts), repeat(np.nan)), float, len(ids))
        rare = np.isnan(flat)
        own = ids < words.first_class
        flat0 = np.where(rare, 0, flat)
        total = lambda x: np.add.reduceat(x, begins)
        others = [Counter(t for t in text if t not in logs) if r else {} for text, r in zip(texts, total(rare.astype(np.int64)), strict=True)]
        return {
            "doc_id": batch.column("doc_id"),
            "held_out": batch.column("held_out"),
            "n_tokens": n,
            "known": total((~rare).astype(np.int64)),
            "base": total(flat0) - n * base,
            "main": total(symbol + np.where(own, 0, flat0)),
            "rare": pa.array([list(c) for c in others], pa.list_(pa.binary())),
            "times": pa.array([list(c.values()) for c in others], pa.list_(pa.int64())),
        }

    schema = "doc_id long, held_out boolean, n_tokens long, known long, base double, main double, rare array<binary>, times array<long>"
    parts = per_batch(docs.withColumn("doc_id", F.col("doc_id").cast("long")), rows, schema)
    parts, _ = materialize(parts.withColumn("row", F.monotonically_increasing_id()), "score-parts")
    spread = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("t"))
    c = F.coalesce("c", F.lit(0))
    rest = spread.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("t") * F.log10(c + SMOOTH)).alias("more"), F.sum(F.when(c > 0, F.col("t")).otherwise(0)).alias("found")
    )
    more = F.coalesce("more", F.lit(0.0))
    return parts.drop("rare", "times").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("main") + more).alias("score"),
    )


def lm_query(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
