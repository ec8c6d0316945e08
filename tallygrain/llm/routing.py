"""Learned partitions of vectors: a balanced cut of a neighbour graph and a classifier that routes.

All of it is fitted on a bounded sample: the graph of nearest neighbours, its recursive spectral
bisection into parts of equal size with capacity-bound refinement, and a network of one hidden
layer that predicts the part of a vector's neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def nearest(x: np.ndarray, y: np.ndarray, k: int, skip_self: bool = False) -> np.ndarray:
    """Rows of ``y`` with the largest inner products, for each row of ``x``, in blocks."""
    found = []
    for at in range(0, len(x), 256):
        s = x[at : at + 256] @ y.T
        if skip_self:
            s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        k_ = min(k, s.shape[1] - skip_self)
        found.append(np.argpartition(-s, k_ - 1, axis=1)[:, :k_] if k_ > 0 else np.zeros((len(s), 0), np.int64))
    return np.concatenate(found) if found else np.zeros((0, 0), np.int64)


def _bisect(nodes: np.ndarray, near: np.ndarray, parts: int, out: np.ndarray, first: int, rng) -> None:
    """Splits by the second eigenvector of the smoothed graph, at a quantile, so both sides keep their share."""
    if parts == 1:
        out[nodes] = first
        return
    place = np.full(len(out), -1)
    place[nodes] = np.arange(len(nodes))
    local = place[near[nodes]]
    inside = local >= 0
    local = np.where(inside, local, 0)
    v = rng.normal(size=len(nodes))
    for _ in range(40):
        spread = (v[local] * inside).sum(1)
        back = np.bincount(local.ravel(), (v[:, None] * inside).ravel(), len(nodes))
        degree = inside.sum(1) + np.bincount(local.ravel(), inside.ravel(), len(nodes))
        v = v + (spread + back) / np.maximum(degree, 1)
        v -= v.mean()
        v /= np.linalg.norm(v) + 1e-12
    left = parts // 2
    order = np.argsort(v, kind="stable")
    cut = len(nodes) * left // parts
    _bisect(nodes[order[:cut]], near, left, out, first, rng)
    _bisect(nodes[order[cut:]], near, parts - left, out, first + left, rng)


def balanced_parts(near: np.ndarray, parts: int, slack: float = 0.1, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """A part for each node, of at most (1 + slack) times the mean size, cutting few edges."""
    n = len(near)
    out = np.zeros(n, np.int64)
    _bisect(np.arange(n), near, parts, out, 0, np.random.default_rng(seed))
    room = int(np.ceil((1 + slack) * n / parts))
    sizes = np.bincount(out, minlength=parts)
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(n), near.shape[1]), out[near].ravel()), 1)
        np.add.at(votes, (near.ravel(), np.repeat(out, near.shape[1])), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), out]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < room:
                sizes[out[i]] -= 1
                sizes[best[i]] += 1
                out[i] = best[i]
                moved += 1
        if not moved:
            break
    return out


@dataclass
class Router:
    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def ranked(self, x: np.ndarray, count: int) -> np.ndarray:
        """The most probable parts of each row, best first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :count]


def train_router(x: np.ndarray, target: np.ndarray, hidden: int = 96, epochs: int = 30, seed: int = 5) -> Router:
    """Cross-entropy against ``target`` (a distribution over parts for each row), by Adam."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), float(x.std()) or 1.0
    p = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, target.shape[1])), np.zeros(target.shape[1])]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    z = (x - mean) / scale
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            b = order[at : at + 256]
            h = np.maximum(z[b] @ p[0] + p[1], 0)
            s = h @ p[2] + p[3]
            q = np.exp(s - s.max(1, keepdims=True))
            d = (q / q.sum(1, keepdims=True) - target[b]) / len(b)
            dh = (d @ p[2].T) * (h > 0)
            t += 1
            for i, g in enumerate([z[b].T @ dh, dh.sum(0), h.T @ d, d.sum(0)]):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] -= 0.004 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Router(mean, scale, *p)


def fit_router(sample: np.ndarray, parts: int, k: int, recall: float) -> Router:
    """A router whose number of probes reaches ``recall`` on sample rows that it was not trained on."""
    held = max(1, len(sample) // 8) if len(sample) > 16 else 0
    test, x = sample[:held], sample[held:]
    parts = max(1, min(parts, len(x) // 16))
    near = nearest(x, x, 16, skip_self=True)
    part = balanced_parts(near, parts) if parts > 1 else np.zeros(len(x), np.int64)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1.0)
    target[np.arange(len(x)), part] += max(1, near.shape[1] // 2)
    router = train_router(x, target / target.sum(1, keepdims=True))
    if parts == 1 or not held:
        router.probes = parts
        return router
    home = router.ranked(x, 1)[:, 0]
    homes = home[nearest(test, x, k)]
    ranks = np.argsort(np.argsort(-router.logits(test), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(ranks, homes, axis=1)
    reached = [(needed < r).mean() for r in range(1, parts + 1)]
    router.probes = 1 + next(i for i, r in enumerate(reached) if r >= recall)
    return router
