import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tallygrain.llm import frames, suffix_dedup, suffix_sort


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc\x00\xff", bytes(range(256))])
def test_suffix_array_is_the_sorted_suffixes(alphabet):
    rng = random.Random(len(alphabet))
    for n in [0, 1, 2, 3, 17, 200]:
        text = bytes(rng.choice(alphabet) for _ in range(n))
        assert suffix_sort.suffix_array(text, 300).tolist() == sorted(range(n), key=lambda i: text[i:])


def test_rising_suffixes_are_smaller_than_their_successors():
    text = b"mississippi\x00\x00zza"
    want = [text[i:] < text[i + 1 :] for i in range(len(text))]
    assert suffix_sort.rising(np.frombuffer(text, np.uint8)).tolist() == want


def test_adjacent_prefixes():
    text = b"abcdefghij" * 3 + b"abcdefgh!"
    order = suffix_sort.suffix_array(text, 50)
    got = suffix_sort.adjacent_prefixes(text, order, 9)
    want = [len(text[a : a + 9]) == 9 and text[a : a + 9] == text[b : b + 9] for a, b in zip(order, order[1:], strict=False)]
    assert got.tolist() == want


def test_regions_cover_each_start_once_and_equal_strings_share_their_gram():
    rng = random.Random(3)
    part = bytes(rng.choice(b"abcdefgh") for _ in range(500))
    text = bytes(rng.choice(b"abcdefgh") for _ in range(700)) + part + bytes(rng.choice(b"abcdefgh") for _ in range(300)) + part
    starts = {}
    for first, counts, grams in suffix_dedup.regions(text, 400):
        for s, c, g in zip(first.tolist(), counts.tolist(), grams.tolist(), strict=True):
            for i in range(s, s + c):
                assert i not in starts
                starts[i] = g
    assert sorted(starts) == list(range(len(text) - 399))
    for i in range(700, 800):
        assert starts[i] == starts[i + 800]


def brute(rows, length):
    """(bytes, removed, spans, digest) of each text by counting all strings."""
    seen = Counter(b[i : i + length] for b in rows for i in range(len(b) - length + 1))
    out = []
    for b in rows:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        spans = int((np.diff(gone.astype(int)) == 1).sum())
        gone = gone[1:-1]
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def query(docs, length):
    keyed = suffix_dedup.keyed(docs, "doc_id")
    rows = keyed.join(suffix_dedup.repeated_spans(keyed, length), "key", "left").collect()
    out = []
    for r in rows:
        runs = suffix_dedup.merged(r.spans)
        b = r.text.encode()
        out.append((len(b), sum(y - x for x, y in runs), len(runs), hashlib.sha256(suffix_dedup.keep(b, runs)).hexdigest()))
    return out


@pytest.mark.parametrize("length", [64, 400])
def test_awkward_texts(awkward, texts, length):
    rows = [(t or "").encode() for t in [*texts, texts[15]]]
    assert sorted(query(awkward, length)) == sorted(brute(rows, length))


def test_real_texts(spark, sf_dir, real):
    docs = {r.doc_id: r.text.encode() for r in real.collect()}
    want = dict(zip(docs, brute(list(docs.values()), 400), strict=True))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_query(spark, sf_dir).collect()}
    assert got == want


def test_the_query_tells_what_is_left(spark, sf_dir, real):
    docs = {r.doc_id: r.text for r in real.collect()}
    left = {r.doc_id: r.text for r in suffix_dedup.suffix_query(spark, sf_dir).where("n_removed > 0").collect()}
    seen = Counter(b[i : i + 400] for b in (t.encode() for t in docs.values()) for i in range(len(b) - 399))
    assert left and all(len(t.encode()) < len(docs[i].encode()) for i, t in left.items())
    whole = {r.doc_id: (r.text, r.n_bytes) for r in suffix_dedup.suffix_query(spark, sf_dir).where("n_removed = 0").collect()}
    assert all(docs[i] == t and len(t.encode()) == n for i, (t, n) in whole.items())
    assert all(seen[b[j : j + 400]] == 1 for b in (docs[i].encode() for i in whole) for j in range(len(b) - 399))


def test_empty_table_and_short_length(nothing):
    docs = suffix_dedup.keyed(nothing, "doc_id")
    assert suffix_dedup.repeated_spans(docs, 400).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.repeated_spans(docs, 20)


def test_long_texts_are_hashed_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 512)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    rng = random.Random(9)
    part = "".join(rng.choice("abcdef ") for _ in range(900))
    texts = ["".join(rng.choice("abcdef ") for _ in range(3000)) + part, part[100:] + "".join(rng.choice("abcdef ") for _ in range(2000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(query(docs, 400)) == sorted(brute([t.encode() for t in texts], 400))


def test_without_repeats_cuts_whole_characters(spark):
    rng = random.Random(4)
    shared = "".join(rng.choice("éàü日") for _ in range(400))
    docs = spark.createDataFrame([(1, "aè" + shared + "b", "fr", "s"), (2, "cê" + shared + "d", "fr", "s"), (3, None, None, None)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.text, r.n_chars) for r in suffix_dedup.without_repeats(docs, 400).collect()}
    # è and ê start with the same byte as é, à and ü do, but no whole character of theirs repeats
    assert got == {1: ("aèb", 3), 2: ("cêd", 3), 3: ("", 0)}


def test_the_pipeline_shuffles_texts_once_and_writes_no_regions(spark, real, monkeypatch):
    written, plan = ran(spark, lambda: suffix_dedup.without_repeats(real, 256), monkeypatch)
    assert written == [("regions", ["key", "start", "n", "gram"]), ("grams", ["gram"])]
    assert len([x for x in plan if "FileScan" in x and "text#" in x]) == 1
    assert len([x for x in plan if "ReusedExchange" in x and "text#" in x]) == 2


def test_op4_shuffles_texts_once_and_regions_once(spark, sf_dir, monkeypatch):
    written, plan = ran(spark, lambda: suffix_dedup.suffix_query(spark, sf_dir), monkeypatch)
    assert [label for label, _ in written] == ["regions", "grams"]
    assert len([x for x in plan if "FileScan" in x and "text#" in x]) == 1
    assert len([x for x in plan if "ReusedExchange" in x and "text#" in x]) == 2
    dealt = [x for x in plan if "Exchange hashpartitioning(gram#" in x and "Reused" not in x]
    assert len([x for x in dealt if "REPARTITION_BY_COL" in x]) == 1 and not [x for x in dealt if "region#" in x]


def test_regions_of_many_batches_are_counted_together(spark, monkeypatch):
    monkeypatch.setattr(frames, "BATCH_ROWS", "2")
    rng = random.Random(12)
    some = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    passage, copy = some(700), some(900)
    texts = [*[some(50) + passage + some(60) for _ in range(9)], *[copy] * 7, passage * 3, some(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(query(docs, 400)) == sorted(brute([t.encode() for t in texts], 400))


def test_what_very_many_texts_share_is_dealt_by_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", 6)
    rng = random.Random(13)
    some = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    passage, line = some(1500), some(90)
    pairs = [(some(300), some(300)) for _ in range(20)]
    texts = [some(200) + before + passage + after + some(40) for before, after in pairs * 2]
    texts += [some(450) + passage + some(450) for _ in range(30)] + [some(400) + line * 12 + some(400) for _ in range(12)] + [passage, passage]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(query(docs, 400)) == sorted(brute([t.encode() for t in texts], 400))
    keyed = suffix_dedup.keyed(docs, "doc_id")
    of = {bytes(r.key): r.text.encode() for r in keyed.collect()}
    meeting = {}
    for r in suffix_dedup.candidates(keyed, 400).collect():
        meeting.setdefault(r.gram, set()).add(of[bytes(r.key)][r.start : r.start + r.n + 399])
    assert {len(b) for bodies in meeting.values() for b in bodies} >= {400, 431}
    assert max(map(len, meeting.values())) <= 6 + 1  # crowds are counted by sketch
    left = lambda cut: {(bytes(r.key), x) for r in suffix_dedup.repeated_spans(keyed, 400, cut).collect() for x in suffix_dedup.merged(r.spans)}
    assert left(True) == left(False)


@pytest.mark.parametrize("width", [32, 1])
def test_pieces_cover_a_region_once_and_equal_strings_share_their_name(width):
    rng = random.Random(14)
    some = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    part = some(700)
    text = some(333) + part + some(777) + part + some(100)
    names = {}
    for found in suffix_dedup.placed_regions(text, 400):
        for start, n, _, gram in zip(*(x.tolist() for x in found), strict=True):
            got = [(i, name) for a, m, name in suffix_dedup.pieces(text, start, n, gram, 400, width) for i in range(a, a + m)]
            assert sorted(i for i, _ in got) == list(range(start, start + n))
            names |= dict(got)
    assert all(names[333 + i] == names[333 + 700 + 777 + i] for i in range(301))


def ran(spark, frame, monkeypatch):
    """(label, columns) of the tables that a query wrote, and the lines of its final plan without broadcasts."""
    written, write = [], suffix_dedup.materialize
    monkeypatch.setattr(suffix_dedup, "materialize", lambda df, label: written.append((label, df.columns)) or write(df, label))
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = frame()
        assert df.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    return written, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
