import random
import re
import textwrap

import pytest

from tallygrain.llm import licenses
from tallygrain.llm.license_texts import TEMPLATES

SCANNER = licenses.Scanner()


def found(text):
    return [m.license for m in SCANNER.find(text)]


@pytest.mark.parametrize("name, text", TEMPLATES)
def test_every_template_is_its_own_license(name, text):
    match = SCANNER.find(text)
    assert [(m.license, m.differences) for m in match] == [(name, 0)]
    wrapped = "\n".join(f" * {line}" for line in re.findall(r".{1,60}(?:\s|$)", text, re.S))
    assert found(wrapped.upper()) == [name]


def test_compression_ranks_the_template_first():
    for size, held in SCANNER.sizes.items():
        for i in held:
            ranks = SCANNER.ranked(" ".join(SCANNER.words[i]), size)
            own = next(saved for saved, k in ranks if k == i)
            assert own >= ranks[0][0] - 2  # of wordings that differ by a number, either may be a byte or two ahead


def test_every_notice_lies_whole_in_a_window_with_a_cue():
    for i, words in enumerate(SCANNER.words):
        assert sum(bool(licenses.CUE_WORD.match(w)) for w in words) > SCANNER.may[i], words
        size = next(n for n, held in SCANNER.sizes.items() if i in held)
        for before in range(2 * size):
            text = ["x"] * before + words + ["x"] * size
            assert any(a <= before and before + len(words) <= b for a, b in SCANNER.windows(text, size))


def every_place(text):
    """All templates compared at all words of a text, without windows and compression."""
    low = text.encode().lower()
    words, at = licenses.words_at(low)
    places = range(-3, len(words))
    confirmed = set().union(*(SCANNER.confirm(low, words, at, i, p) for i in range(len(SCANNER.words)) for p in places))
    return [m.license for m, _, _ in SCANNER.settled(words, confirmed)]


def test_agrees_with_all_templates_at_all_places():
    rng = random.Random(9)
    other = [w for _, t in TEMPLATES for w in t.split()]
    short = [t for _, t in TEMPLATES if len(t.split()) < 40]
    for _ in range(30):
        words = []
        for _ in range(rng.randrange(1, 4)):
            notice = rng.choice(short).split()
            for _ in range(rng.randrange(3)):
                p = rng.randrange(len(notice))
                notice[p : p + rng.randrange(2)] = [rng.choice(other)] * rng.randrange(2)
                notice = notice or ["x"]
            words += [rng.choice(other) for _ in range(rng.randrange(20))] + notice
        text = " ".join(words)
        assert found(text) == every_place(text), text


def test_templates_save_wherever_they_stand():
    """Windows full of words of other notices, with a whole short notice anywhere in them."""
    rng = random.Random(12)
    other = [w for words in SCANNER.words for w in words]
    for size, held in SCANNER.sizes.items():
        for i in held if size <= 32 else []:
            for _ in range(100):
                around = [rng.choice(other) for _ in range(size - len(SCANNER.words[i]))]
                at = rng.randrange(len(around) + 1)
                assert i in [r[1] for r in SCANNER.ranked(" ".join(around[:at] + SCANNER.words[i] + around[at:]), size)]


def test_usual_variants_are_found():
    assert found("Licensed under the MIT License.") == found("Distributed under the MIT License") == found("Released under MIT License") == ["MIT"]
    assert found("Licensed under the Apache License 2.0") == found("Licensed under Apache Licence v2.0.") == ["Apache-2.0"]
    assert found("SPDX-License-Identifier: BSD-3-Clause") == ["BSD-3-Clause"]
    assert found("# SPDX-License-Identifier: GPL-3.0-or-later\n") == ["GPL-3.0-or-later"]
    assert found("This work is licensed under the Creative Commons Attribution 4.0 International License.") == ["CC-BY-4.0"]


def test_negations_and_longer_identifiers_are_not_found():
    assert found("not all rights reserved") == found("It isn't licensed under the MIT License.") == []
    assert found("This work is not licensed under a Creative Commons Attribution 4.0 International License.") == []
    assert found("Use it or not. All rights reserved.") == ["All-rights-reserved"]
    assert found("SPDX-License-Identifier: MIT-0") == found("SPDX-License-Identifier: BSD-3-Clause-Clear") == []


def test_ties_go_to_the_template_listed_first():
    same = licenses.Scanner([("one", "Released under the X1 License."), ("two", "Released under an X1 licence")])
    assert [m.license for m in same.find("released under the X1 license")] == ["one"]


def test_wording_decides():
    assert found("Licensed under CC BY 3.0.") == []
    assert found("Licensed under the Apache License, Version 1.1.") == []
    assert found("Licensed under CC BY-NC-ND 4.0.") == []
    assert found("This work is licenced under the GNU General Public License, version 4.") == []
    assert found("This file is released under the MIT license") == ["MIT"]
    assert found("Copyright (c) 2011 Bob\n" + TEMPLATES[5][1] + "\nAll rights reserved.") == ["MIT", "All-rights-reserved"]
    assert found("driver's license required") == [] and found("") == []


def test_blocks_are_runs_of_lines_with_cues():
    text = b"one\nCopyright 2020 X\nfiller\nAll rights reserved.\n\nthis\nmore\nReleased under the MIT License.\nend"
    blocks = licenses.candidate_blocks(text)
    assert [text[a : a + len(b)] == b for a, b in blocks] == [True, True]
    assert [b for _, b in blocks] == [b"Copyright 2020 X\nfiller\nAll rights reserved.", b"Released under the MIT License."]
    assert licenses.candidate_blocks(b"") == [] and licenses.candidate_blocks(b"plain\ntext") == []


def test_real_rows(spark, sf_dir, real):
    """The license lines of the table, found by plain search."""
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "All rights reserved.": "All-rights-reserved"}
    want = sorted((r.doc_id, lines[x]) for r in real.collect() for x in r.text.split("\n") if x in lines)
    got = sorted((r.doc_id, r.license) for r in licenses.license_query(spark, sf_dir).collect() if r.license)
    assert got == want


def test_awkward_rows(spark, awkward, nothing):
    assert licenses.scanned(awkward).where("size(licenses) > 0").count() == 0
    assert licenses.scanned(nothing).count() == 0
    text = "Licensed under the MIT License. " + "word " * 400_000 + "\nAll rights reserved."
    long = spark.createDataFrame([(1, text, "x", "y")] * 2, "doc_id long, text string, block string, licenses string")
    assert sorted([m.license for m in r.licenses] for r in licenses.scanned(long).collect()) == [["MIT", "All-rights-reserved"]] * 2
    odd = spark.createDataFrame([(None, "All rights reserved."), (1, "Released under the MIT License.\n" * 3), (1, None)], "doc_id long, text string")
    rows = sorted(licenses.scanned(odd).collect(), key=lambda r: r.start + len(r.block))
    assert [[m.license for m in r.licenses] for r in rows] == [["All-rights-reserved"], ["MIT"] * 3]


def wrapped(text, width=72):
    return textwrap.fill(" ".join(text.split()), width, break_long_words=False, break_on_hyphens=False)


@pytest.mark.parametrize("width", [20, 40, 72])
def test_wrapped_files_are_found(spark, width):
    """Notices broken into lines, with blank lines between their sentences, within other text."""
    texts = [f"Prose before it.\n\n{wrapped(t, width)}\n\nint main() {{}}\n" for _, t in TEMPLATES]
    texts += [f"# Read me\n\n{re.sub(r'[.:;] ', lambda m: m[0].strip() + chr(10) * 2, wrapped(t, 2000))}\n\nMore." for _, t in TEMPLATES]
    rows = licenses.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {}
    for r in rows:
        assert texts[r.doc_id].encode()[r.start :].startswith(r.block.encode())
        found.setdefault(r.doc_id, []).extend(m.license for m in r.licenses)
    assert [found[i] for i in range(len(texts))] == [[n] for n, _ in TEMPLATES] * 2


def test_short_notices_inside_long_lines_are_found():
    """Also where longer templates save more by common words, and where several notices share a line."""
    rng = random.Random(4)
    common = [w for _, t in TEMPLATES for w in t.split() if w.islower() and w.isalpha()]
    for name, text in TEMPLATES:
        for _ in range(10):
            lines = " ".join(rng.choice(common) for _ in range(300))
            assert found(f"{lines}. {text} {lines}") == [name]
    short = [(n, t) for n, t in TEMPLATES if len(t.split()) < 12]
    assert found(" Also: ".join(t for _, t in short)) == [n for n, _ in short]
