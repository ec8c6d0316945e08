"""Two-stage suffix sorting of one block of bytes in numpy."""

from __future__ import annotations

import numpy as np


def rising(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last suffix is not."""
    n = len(text)
    step = np.zeros(n, np.int16)
    step[:-1] = text[1:].astype(np.int16) - text[:-1]
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    return step[following] > 0


def words8(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one big-endian number, zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray((len(text),), dtype=">u8", buffer=padded.tobytes(), strides=(1,)).astype(np.uint64)


def sort_directly(text: bytes, heads: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of their first ``depth`` bytes: by 8 bytes at once, then ties by slices."""
    keys = heads[starts]
    order = np.argsort(keys, kind="stable")
    ranked, keys = starts[order], keys[order]
    edges = np.flatnonzero(np.diff(keys)) + 1
    first, last = np.concatenate([[0], edges]), np.concatenate([edges, [len(ranked)]])
    tied = last - first > 1
    for a, b in zip(first[tied].tolist(), last[tied].tolist(), strict=True):
        ranked[a:b] = sorted(ranked[a:b].tolist(), key=lambda i: text[i : i + depth])
    return ranked


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """Suffixes of ``text`` in the order of at least their first ``depth`` bytes.

    Only suffixes smaller than their successors are sorted directly. The others follow from one
    scan over the buckets of first bytes in ascending order: within a bucket they come before the
    sorted ones, in the order in which their successors are met. Inside a run of one byte the
    scan repeats over what it has just found.
    """
    t = np.frombuffer(text, np.uint8)
    n = len(t)
    if not n:
        return np.zeros(0, np.int64)
    up = rising(t)
    heads = words8(t)
    direct = sort_directly(text, heads, np.flatnonzero(up), depth)
    cuts = np.searchsorted(t[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def hand_on(found: np.ndarray) -> None:
        before = found - 1
        before = before[before >= 0]
        before = before[~up[before]]
        if len(before):
            byte = t[before]
            order = np.argsort(byte, kind="stable")
            byte, before = byte[order], before[order]
            edges = [0, *(np.flatnonzero(np.diff(byte)) + 1).tolist(), len(byte)]
            for a, b in zip(edges, edges[1:], strict=False):
                waiting[byte[a]].append(before[a:b])

    hand_on(np.array([n]))
    out = []
    for c in range(256):
        met = 0
        while met < len(waiting[c]):
            part = waiting[c][met]
            hand_on(part)
            out.append(part)
            met += 1
        part = direct[cuts[c] : cuts[c + 1]]
        if len(part):
            hand_on(part)
            out.append(part)
    return np.concatenate(out)


def adjacent_prefixes(text: bytes, order: np.ndarray, length: int) -> np.ndarray:
    """For each neighbour pair of ``order``: do they share a prefix of ``length`` bytes?"""
    n = len(text)
    heads = words8(np.frombuffer(text, np.uint8))
    a, b = order[:-1], order[1:]
    same = (a + length <= n) & (b + length <= n) & (heads[a] == heads[b])
    at = np.flatnonzero(same)
    ends = max(0, length - 8)
    at = at[heads[a[at] + ends] == heads[b[at] + ends]] if length >= 8 else at
    same[:] = False
    same[at] = [text[x : x + length] == text[y : y + length] for x, y in zip(a[at].tolist(), b[at].tolist(), strict=True)]
    return same
