import hashlib
import itertools

import pytest

from tallygrain.llm import spotsigs

ANCHORS = spotsigs.anchor_hashes()


def sigs(text):
    return spotsigs.signatures((text or "").encode(), ANCHORS)


def test_signatures_are_chains_after_anchors():
    base = "The house of stone, the silver river and a cold winter in the garden"
    assert len(sigs("")) == 0 and len(sigs(" \n ")) == 0 and len(sigs("the")) > 0
    assert sigs(base).tolist() == sigs(base.upper().replace(",", "!!")).tolist()  # case and punctuation don't count
    changed = sigs(base.replace("garden", "forest"))
    assert 0 < spotsigs.likeness(sigs(base), changed) < 1
    assert len(sigs(" ".join(f"w{i}" for i in range(100)))) > 50  # without common words


def test_an_edit_changes_signatures_nearby_only():
    words = [w if i % 3 else "the" for i, w in enumerate(f"w{j}" for j in range(600))]
    edited = list(words)
    edited[301] = "other"
    a, b = sigs(" ".join(words)), sigs(" ".join(edited))
    assert len(set(a.tolist()) ^ set(b.tolist())) <= 8


def test_likeness():
    assert spotsigs.likeness(sigs(""), sigs(None)) == 1.0
    assert spotsigs.likeness(sigs(""), sigs("some words")) == 0.0
    a, b = sigs("the one two three the four five six"), sigs("the one two three the seven five six")
    common, every = len(set(a.tolist()) & set(b.tolist())), len(set(a.tolist()) | set(b.tolist()))
    assert spotsigs.likeness(a, b) == pytest.approx(common / every)
    assert spotsigs.likeness(a[:1], a, floor=0.9) == 0.0  # lengths alone tell


def brute(rows):
    """rows: (id, text) in order; results with each row's successor."""
    out = []
    for i, (name, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(text) // 4
        edited = text[: len(text) - m] + after[:m]
        out.append((name, len(text), hashlib.sha256(edited.encode()).hexdigest(), spotsigs.fingerprint(sigs(text)), spotsigs.fingerprint(sigs(edited)), spotsigs.likeness(sigs(text), sigs(edited)), spotsigs.likeness(sigs(text), sigs(after))))
    return out


@pytest.mark.parametrize("size", [4000, 5, 1])
def test_awkward_rows(awkward, texts, monkeypatch, size):
    monkeypatch.setattr(spotsigs, "RANGE_DOCS", size)
    rows = [(i, t) for i, t in enumerate(texts) if i != 3] + [(15, texts[15])]
    rows = sorted(rows, key=lambda r: (r[0], r[1] or "")) + [(None, texts[3])]
    key = lambda r: (r[0] is None, r)
    got = [tuple(r) for r in spotsigs.edited_likeness(awkward).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_real_rows(spark, sf_dir, real, nothing):
    rows = sorted((r.doc_id, r.text) for r in real.collect())
    assert sorted(tuple(r) for r in spotsigs.spotsigs_query(spark, sf_dir).collect()) == sorted(brute(rows))
    assert spotsigs.edited_likeness(nothing).count() == 0
    assert sorted(tuple(r) for r in spotsigs.edited_likeness(real.where("doc_id = 7")).collect()) == brute([r for r in rows if r[0] == 7])


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_near_pairs_are_those_of_all_pairs(spark, real, awkward, threshold):
    prints = spotsigs.fingerprints(real).union(spotsigs.fingerprints(awkward))
    if threshold == 1.0:
        with pytest.raises(ValueError):
            spotsigs.near_pairs(prints, threshold)
        return
    sets = {r.fingerprint: set(r.signatures) for r in prints.collect() if r.signatures}
    want = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        share = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if share >= threshold:
            want[a, b] = share
    assert {(r.a, r.b): r.likeness for r in spotsigs.near_pairs(prints, threshold).collect()} == pytest.approx(want)
