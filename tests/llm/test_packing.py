import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallygrain.llm import packing


def plain_first_fit(sizes, room):
    bins, free = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, f in enumerate(free) if f >= sizes[i]), len(bins))
        if at == len(bins):
            bins.append([])
            free.append(room)
        bins[at].append(i)
        free[at] -= sizes[i]
    return bins


def test_tournament_tree_is_first_fit_decreasing():
    rng = random.Random(0)
    for n in [0, 1, 2, 3, 50, 300]:
        sizes = [rng.randint(1, 100) for _ in range(n)]
        assert packing.first_fit_decreasing(sizes, 100) == plain_first_fit(sizes, 100)


def check(lengths, sequences, room):
    pieces = defaultdict(list)
    for s in sequences:
        assert 0 < sum(n for _, _, n in s) <= room
        for doc, start, n in s:
            pieces[doc].append((start, n))
    for doc, total in enumerate(lengths):
        at = 0
        for start, n in sorted(pieces[doc]):
            assert start == at and n > 0
            at += n
        assert at == total


def test_pieces_cover_documents_with_little_padding():
    rng = random.Random(1)
    for n in [1, 2, 10, 500]:
        lengths = [rng.choice([1, 7, 2047, 2048, 2049, rng.randint(1, 9000)]) for _ in range(n)]
        sequences = packing.pack_lengths(lengths)
        check(lengths, sequences, 2048)
        padding = sum(0 if t & (t - 1) == 0 else 2048 - t for t in (sum(p[2] for p in s) for s in sequences))
        assert padding <= packing.SLACK * len(sequences)
    assert packing.pack_lengths([]) == []


def test_awkward_documents(awkward, texts, nothing):
    rows = packing.pack(awkward, group_docs=7).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = lambda t: library.encode(t or "", add_special_tokens=False).ids + [1]
    want = sorted(zlib.crc32(np.array(ids(t), "<u4").tobytes()) for t in [*texts, texts[15]])
    byid = defaultdict(list)
    for r in rows:
        assert r.length * 4 == len(r.ids)
        byid[r.doc_id].append(r)
    for i, t in enumerate(texts):
        if i not in (3, 15):
            parts = sorted(byid[i], key=lambda r: r.start)
            assert b"".join(r.ids for r in parts) == np.array(ids(t), "<u4").tobytes()
            assert {r.doc_tokens for r in parts} == {len(ids(t))}
    assert sum(r.length for r in rows) == sum(len(ids(t)) for t in [*texts, texts[15]])
    assert len(want) == len(texts) + 1
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert packing.pack(nothing).count() == 0


def test_query_is_the_same_twice_and_its_checksums_hold(spark, sf_dir, real):
    first = sorted(tuple(r) for r in packing.packing_query(spark, sf_dir).collect())
    assert first == sorted(tuple(r) for r in packing.packing_query(spark, sf_dir).collect())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = {r.doc_id: np.array(library.encode(r.text, add_special_tokens=False).ids + [1], "<u4") for r in real.collect()}
    for doc, start, length, crc, total, _, _ in first:
        assert total == len(docs[doc]) and crc == zlib.crc32(docs[doc][start : start + length].tobytes())
