"""Public tokenizer files, loaded once in each Python worker."""

from __future__ import annotations

import base64
import sys
from types import ModuleType


def held(name: str, make):
    """``make()``, kept for the life of this Python process."""
    store = sys.modules.setdefault("tallygrain_worker_store", ModuleType("tallygrain_worker_store"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def latest(slot: str, name: str, make):
    """``make()``, kept in this Python process until the slot is asked for another name."""
    store = sys.modules.setdefault("tallygrain_worker_store", ModuleType("tallygrain_worker_store"))
    if (getattr(store, slot, None) or (None,))[0] != name:
        setattr(store, slot, None)  # the one before goes first
        setattr(store, slot, (name, make()))
    return getattr(store, slot)[1]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer(path: str):
    from tokenizers import Tokenizer

    return held(f"json {path}", lambda: Tokenizer.from_file(path))


def byte_encoder(json_path: str, ranks_path: str, pattern: str, special: str = "<|endoftext|>"):
    """text -> list of ids, as the tokenizers library gives them.

    The same vocabulary as ranks encodes three times as fast; a text that holds the special
    token's string, which the library turns into its id, goes to the library.
    """
    import tiktoken

    def ranks():
        with open(ranks_path, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    fast = held(f"ranks {ranks_path}", ranks)

    def encode(text: str) -> list[int]:
        if special in text:
            return tokenizer(json_path).encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode
