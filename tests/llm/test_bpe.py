import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallygrain.llm import bpe_codec
from tallygrain.llm.trie_bpe import TrieBpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(ours, library, texts):
    for text, (ids, decoded) in zip(texts, ours.encode_batch(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)), text
        assert decoded == library.decode(want, skip_special_tokens=False) == ours.decode(want)


def test_awkward_texts(library, texts):
    same(TrieBpe(PATH), library, [t or "" for t in texts])


def test_scripts_and_signs(library):
    odd = [
        "ΑΣΣΟΣ Σ", "İstanbul ǅ ﬁ", "<|endoftext|>abc<|startoftext|> x <|endoftext|", "don't we'll I'M they'Re", "数字 123４５", "a\x1cb\x85c d\xa0e​f g",
        "été Å é", "a" * 700, "-" * 300, "😀😀 !!!???...", "\x00\x7f", "straße ẞ", "ʼn ŀ", "Ⅷ ½ ²", "<|endoftext|>" * 3,
    ]
    same(TrieBpe(PATH), library, odd)


def test_random_words(library):
    rng = random.Random(6)
    letters = ["abcdefghijklmnopqrstuvwxyz", "etaoin srh", "aab", "éüñßøç", "!?.,'-_%&*|", "0123456789"]
    texts = ["".join(rng.choice(rng.choice(letters)) for _ in range(120)) for _ in range(300)]
    anywhere = [(0, 0x2FF), (0x370, 0x1FFF), (0x2000, 0xD7FF), (0x1F000, 0x1F9FF)]
    texts += ["".join(chr(rng.randint(*rng.choice(anywhere))) for _ in range(80)) for _ in range(100)]
    same(TrieBpe(PATH), library, texts)


def test_stable_pairs_are_those_that_plain_bpe_keeps():
    ours = TrieBpe(PATH)
    rng = random.Random(2)
    tokens = [t for t in ours.ids if t.isascii()]
    first = [t for t in tokens if not t.endswith("</w>")]
    pairs = [(rng.choice(first), rng.choice(tokens)) for _ in range(2000)]
    pairs += [(t[:k], t[k:]) for t in rng.sample(tokens, 2000) for k in [rng.randint(1, max(1, len(t) - 1))] if t[:k] in ours.ids and t[k:] in ours.ids]
    for a, b in pairs:
        if ours.alone(a) and ours.alone(b):
            assert ours.stable(a, b) == (ours.merge(ours.symbols(a) + ours.symbols(b)) == [a, b]), (a, b)


def test_forgetting_words_changes_nothing(library, monkeypatch):
    from tallygrain.llm import trie_bpe

    monkeypatch.setattr(trie_bpe, "REMEMBERED", 3)
    ours = TrieBpe(PATH)
    for text in ["one two three four", "two five six", "one seven", ""]:
        same(ours, library, [text, text])


def test_query(spark, sf_dir, real, awkward, nothing, texts, library):
    docs = {r.doc_id: r.text for r in real.collect()}
    for r in bpe_codec.bpe_query(spark, sf_dir).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    got = sorted(r.ids for r in bpe_codec.encoded(awkward).collect())
    assert got == sorted(library.encode(t or "", add_special_tokens=False).ids for t in [*texts, texts[15]])
    assert bpe_codec.digests(nothing).count() == 0
