import hashlib
import random
import zlib

import numpy as np
import pytest

from tallygrain.llm import periodic
from tallygrain.llm.frames import pick


def brute(words, min_length, exponent):
    """(start, length, smallest period) of maximal runs, by trying every period."""
    n, out = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(min_length, exponent * p):
                out.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, k, p) for (s, k), p in out.items())


def some_texts(rng, n):
    out = []
    for _ in range(n):
        alphabet = rng.choice([1, 2, 2, 3, 50])
        base = [rng.randrange(alphabet) for _ in range(rng.randint(0, 40))]
        if base and rng.random() < 0.6:
            unit = base[: rng.randint(1, len(base))]
            base = base + unit * rng.randint(1, 6) + base[: rng.randint(0, 20)]
        out.append(base)
    return out


@pytest.mark.parametrize("min_length, exponent", [(24, 3), (1, 2), (10, 2), (24, 2), (5, 4), (1, 5)])
def test_runs_against_all_periods(min_length, exponent):
    rng = random.Random(min_length * 10 + exponent)
    texts = some_texts(rng, 100)
    for text, rows in zip(texts, periodic.runs_of(texts, min_length, exponent), strict=True):
        assert [tuple(r) for r in rows.tolist()] == sorted(brute(text, min_length, exponent), key=lambda r: (r[0], r[2]))


def test_word_by_word_is_all_at_once():
    rng = random.Random(3)
    text = [rng.randrange(2) for _ in range(60)] * 3
    slow, fast = periodic.SquareCatcher(10, 2, len(text)), periodic.SquareCatcher(10, 2, len(text))
    caught = [slow.append(np.array([w])) for w in text]
    assert sum(caught) == fast.append(np.array(text)) and sum(caught) > 0
    assert (slow.runs() == fast.runs()).all()
    # Told at any time: the runs so far.
    half = periodic.SquareCatcher(10, 2, len(text))
    half.append(np.array(text[:90]))
    assert [tuple(r) for r in half.runs().tolist()] == sorted(brute(text[:90], 10, 2), key=lambda r: (r[0], r[2]))


def test_long_periodic_text_is_one_run():
    (rows,) = periodic.runs_of([[7] * 200_000], 24, 3)
    assert rows.tolist() == [[0, 200_000, 1]]


def test_awkward_rows(spark, awkward, texts):
    rows = periodic.periodic_runs(awkward, "doc_id", "component_id").collect()
    assert len(rows) == len(texts) + 1
    seen = {}
    for r in rows:
        seen.setdefault(r.doc_id, r)
    for i, t in enumerate(texts):
        if i == 3:
            continue
        words = (t or "").encode().split()
        want = brute(words, 24, 3) if len(words) < 4000 else None
        got = [(x.start, x.length, x.period) for x in seen[i].runs]
        assert seen[i].n_words == len(words) and (want is None or got == want)
        gone = {k for s, length, p in got for k in range(s + p, s + length)}
        assert seen[i].collapsed.encode() == b" ".join(w for k, w in enumerate(words) if k not in gone)
    assert [tuple(x) for x in seen[6].runs] == [(0, 3000, 1)] and seen[6].collapsed == "word"


def test_empty_table(spark, nothing):
    assert periodic.periodic_runs(nothing, "doc_id").collect() == []


def test_query_against_brute_force(spark, sf_dir, real):
    got = {r.doc_id: r for r in periodic.periodic_query(spark, sf_dir).collect()}
    assert len(got) == real.count()
    for d in pick(real, "doc_id", "text").collect():
        words = d.text.encode().split()
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        elif n > 1500:
            continue
        runs = sorted(brute(words, 24, 3), key=lambda r: (r[0], r[2]))
        r = got[d.doc_id]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in runs).encode()).hexdigest()
        if runs:
            s, k, p = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, k, p, 1000 * k // p)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
