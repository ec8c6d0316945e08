"""Packing of tokenised documents into sequences: first-fit decreasing in random groups.

Documents are dealt to groups by a hash of id and text, some thousand each, so a group is a
random sample, fits one task at any table size, and comes out the same when it is run again.
Within a group every document gives its full sequences; the rests are packed first-fit
decreasing, where a tournament tree over the bins' free room finds the first bin that fits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.frames import pick, table
from tallygrain.llm.vocabularies import byte_encoder, public_path

ROOM = 2048
GROUP_DOCS = 1000
END = 1
#: Free room, in tokens, that is left as padding; cutting documents for less isn't worth it.
SLACK = 64


class Tournament:
    """Free room of ``bins`` bins as leaves; each inner node holds the larger of its children."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, (bins - 1)).bit_length()
        self.most = [room] * (2 * self.leaves)

    def first_fit(self, need: int) -> int:
        """Takes ``need`` from the first bin with as much room; returns its number."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < need:
                node += 1
        most[node] -= need
        found = node - self.leaves
        while node > 1:
            node //= 2
            most[node] = max(most[2 * node], most[2 * node + 1])
        return found


def first_fit_decreasing(sizes: list[int], room: int) -> list[list[int]]:
    """Items of each bin, for sizes of at most ``room``; equal sizes keep their order."""
    tree = Tournament(len(sizes), room)
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.first_fit(sizes[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def level(bins: list[list[tuple[int, int, int]]], room: int, slack: int) -> list[list[tuple[int, int, int]]]:
    """Pours the emptiest bins into the gaps above ``slack`` of the others, cutting their pieces.

    A piece is (document, start, length). What stays in one last bin is cut into sequences whose
    lengths are powers of two, which need no padding.
    """
    free = lambda b: room - sum(p[2] for p in b)
    loose = sorted((b for b in bins if free(b) > slack), key=free)
    done = [b for b in bins if free(b) <= slack]
    while len(loose) > 1:
        pour, gap = loose[-1], free(loose[0])
        while gap and pour:
            doc, start, n = pour.pop()
            take = min(n, gap)
            loose[0].append((doc, start, take))
            gap -= take
            if take < n:
                pour.append((doc, start + take, n - take))
        if not gap:
            done.append(loose.pop(0))
        if not pour:
            loose.pop()
    for last in loose:
        left = room - free(last)
        while left:
            size = 1 << (left.bit_length() - 1)
            part, need = [], size
            while need:
                doc, start, n = last.pop(0)
                take = min(n, need)
                part.append((doc, start, take))
                need -= take
                if take < n:
                    last.insert(0, (doc, start + take, n - take))
            done.append(part)
            left -= size
    return done


def pack_lengths(lengths: list[int], room: int = ROOM, slack: int = SLACK) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of pieces (document, start, length)."""
    full = [[(i, s, room)] for i, n in enumerate(lengths) for s in range(0, n - room + 1, room)]
    rests = [(i, n - n % room, n % room) for i, n in enumerate(lengths) if n % room]
    bins = first_fit_decreasing([r[2] for r in rests], room)
    return full + level([[rests[i] for i in b] for b in bins], room, slack)


def pack(
    docs: DataFrame,
    json_path: str | None = None,
    ranks_path: str | None = None,
    room: int = ROOM,
    group_docs: int = GROUP_DOCS,
    end: int = END,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers. Every row of
    ``docs`` is one document, also where rows repeat or ids are null; a null or empty text is the
    end token alone. No group spans tasks, so a lost executor repeats whole groups. One very long
    document is held in memory by its task, as its row is anyway.
    """
    import public_tokenizers

    json_path = json_path or public_path("byte_bpe_50k.json")
    ranks_path = ranks_path or public_path("byte_bpe_50k.tiktoken")
    pattern = public_tokenizers.PATTERN
    docs = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    groups = max(1, -(-docs.count() // group_docs))
    dealt = docs.withColumn("tie", F.xxhash64("doc_id", "text")).withColumn("group", F.pmod("tie", F.lit(groups)))

    def run(group: pa.Table) -> pa.Table:
        encode = byte_encoder(json_path, ranks_path, pattern)
        group = group.sort_by([("tie", "ascending"), ("doc_id", "ascending")])
        names = group.column("doc_id").to_pylist()
        number = group.column("group")[0].as_py()
        ids = [np.array([*encode(text.as_py()), end], "<u4") for text in group.column("text")]
        rows = [
            (names[i], start, n, len(ids[i]), (number << 32) + s, offset, ids[i][start : start + n].tobytes())
            for s, pieces in enumerate(pack_lengths([len(x) for x in ids], room))
            for (i, start, n), offset in zip(pieces, np.cumsum([0] + [p[2] for p in pieces]).tolist(), strict=False)
        ]
        columns = list(zip(*rows, strict=True))
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
        out = {k: pa.array(v, pa.int64()) for k, v in zip(names, columns, strict=False)}
        return pa.table(out | {"ids": pa.array(columns[6], pa.binary())})

    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return dealt.groupBy("group").applyInArrow(run, schema)


def packing_query(spark, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
