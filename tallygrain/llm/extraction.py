"""Main text of web pages by a recurrent labeller of their blocks."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm import label_lstm
from tallygrain.llm.frames import per_batch, pick, table
from tallygrain.llm.html_blocks import Block, blocks, vectors
from tallygrain.llm.page_samples import Maker

#: Pages that the labeller is fitted on, at most; drawn layouts.
FIT_PAGES, DRAWN = 400, 900

MARK = "\x02"
INSIDE = {"article", "main"}
OUTSIDE = {"nav", "footer", "aside", "form", "ad", "ads", "advert", "comments", "comment", "sidebar", "cookie", "menu"}


def marked(found: list[Block]) -> np.ndarray | None:
    """Labels of a page whose own markup tells: text inside an article element; None if it has none."""
    if not any(INSIDE & set(b.path) for b in found):
        return None
    return np.array([bool(INSIDE & set(b.path)) and not OUTSIDE & set(b.path) for b in found], float)


def drawn(texts: list[str], count: int, seed: int) -> list[tuple[str, list[Block], np.ndarray]]:
    """Pages of many layouts with the label of each block."""
    out = []
    maker = Maker(texts, seed)
    while len(out) < count:
        pieces = maker.page()
        # A mark in the text of each labelled piece tells its blocks, whatever the parser makes of them.
        labels = np.array([float(MARK in b.text) for b in blocks("".join(_marked(p, label) for p, label in pieces))])
        page = "".join(p for p, _ in pieces)
        found = blocks(page)
        if len(found) == len(labels) and found:
            out.append((page, found, labels))
    return out


def _marked(piece: str, label: int) -> str:
    """The piece with a mark before the first letter of its text, if it is main text."""
    if label != 1:
        return piece
    at = 0
    while at < len(piece) and piece[at] == "<":
        at = piece.index(">", at) + 1
    return piece[:at] + MARK + piece[at:]


def learn(pages: DataFrame, fit_pages: int = FIT_PAGES, layouts: int = DRAWN) -> dict[str, np.ndarray]:
    """A labeller fitted on at most ``fit_pages`` pages, those with the smallest hash.

    Their paragraphs fill layouts of many kinds, so that it learns parts that the given pages don't
    have; those pages whose markup names the article are learnt from as they are, too.
    """
    chosen = pages.where("html is not null").select("html").orderBy(F.xxhash64("html"), "html").limit(fit_pages)
    real = [blocks(h) for h in (r["html"] for r in chosen.toLocalIterator())]
    texts = [b.text for found in real for b in found if len(b.text) > 40] or ["No page has any text to learn from."]
    random.Random(1).shuffle(texts)
    known = [(f, y) for f in real if f and (y := marked(f)) is not None]
    samples = [(f, y) for _, f, y in drawn(texts[:4000], layouts, 2)] + known
    return label_lstm.fit([vectors(f) for f, _ in samples], [y for _, y in samples])


def extracted(pages: DataFrame, fit_pages: int = FIT_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html).

    Blocks labelled main text, in page order, joined by line breaks. A null or empty page, or one
    without main text, gives the empty text.
    """
    rows_in = pick(pages, "page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    model = learn(rows_in, fit_pages)

    def rows(batch: pa.RecordBatch) -> dict:
        found = [blocks(h or "") for h in batch.column("html").to_pylist()]
        texts = []
        for at in range(0, len(found), 500):
            part = found[at : at + 500]
            for f, q in zip(part, label_lstm.predict(model, [vectors(x) for x in part]), strict=True):
                texts.append("\n".join(b.text for b, p in zip(f, q.tolist(), strict=True) if p >= 0.5))
        return {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "text": texts,
            "n_chars": pa.array(map(len, texts), pa.int64()),
        }

    return per_batch(rows_in, rows, "page_id long, url string, text string, n_chars long")


def html_query(spark, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
