"""Generalised additive model with pairwise interactions, fitted by cyclic boosting in numpy.

Every feature is cut into bins and owns a lookup table over them; chosen pairs of features own a
table over both. A round visits the features in turn and adds to each table a shallow tree (three
leaves) fitted to the current gradient; pairs follow once the single features are settled. Scoring
finds the bins and adds up table entries, whole columns at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np


@dataclass
class AdditiveModel:
    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for (a, b), (ca, cb), table in zip(self.pairs, self.pair_cuts, self.pair_tables, strict=True):
            total += table[np.searchsorted(ca, x[:, a], side="right"), np.searchsorted(cb, x[:, b], side="right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _quantile_edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.zeros(0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int, penalty: float) -> np.ndarray:
    """Leaf value of each bin; splits the leaf with the largest gain until there are ``leaves``."""
    total_g, total_h = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    parts = [(0, len(g))]
    worth = lambda a, b: (total_g[b] - total_g[a]) ** 2 / (total_h[b] - total_h[a] + penalty)
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for a, b in parts:
            if b - a > 1:
                cuts = np.arange(a + 1, b)
                gain = worth(a, cuts) + worth(cuts, b) - worth(a, b)
                if gain.max() > best[0]:
                    best = (gain.max(), (a, b), int(cuts[gain.argmax()]))
        if best[1] is None:
            break
        a, b = best[1]
        parts.remove((a, b))
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (total_g[b] - total_g[a]) / (total_h[b] - total_h[a] + penalty)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Best split of a grid of bins into four quadrants: its gain and the value of each cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)

    def four(c):
        top, all_ = c[:-1, :-1], c[-1, -1]
        right, down = c[:-1, -1:] - top, c[-1:, :-1] - top
        return top, right, down, all_ - top - right - down

    parts = list(zip(four(cg), four(ch), strict=True))
    gain = sum(a**2 / (b + penalty) for a, b in parts) - cg[-1, -1] ** 2 / (ch[-1, -1] + penalty)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    value = [a[i, j] / (b[i, j] + penalty) for a, b in parts]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 40, pairs: int = 8, bins: int = 48, rate: float = 0.1) -> AdditiveModel:
    """Labels are 0 and 1. Without both of them the model is the smoothed share of ones."""
    penalty, n, width = 1.0, len(y), x.shape[1]
    prior = (y.sum() + 1) / (n + 2)
    edges = [_quantile_edges(x[:, f], bins) for f in range(width)]
    model = AdditiveModel(edges, float(np.log(prior / (1 - prior))), [np.zeros(len(e) + 1) for e in edges])
    if not 0 < y.sum() < n:
        return model
    at = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    margin = np.full(n, model.intercept)

    def gradient():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(width):
            g, h = gradient()
            size = len(edges[f]) + 1
            step = rate * _shallow_tree(np.bincount(at[f], g, size), np.bincount(at[f], h, size), 3, penalty)
            model.tables[f] += step
            margin += step[at[f]]

    cuts = [_quantile_edges(x[:, f], 12) for f in range(width)]
    coarse = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]

    def grid(a, b, v):
        shape = (len(cuts[a]) + 1, len(cuts[b]) + 1)
        return np.bincount(coarse[a] * shape[1] + coarse[b], v, shape[0] * shape[1]).reshape(shape)

    g, h = gradient()
    gains = {(a, b): _quadrants(grid(a, b, g), grid(a, b, h), penalty)[0] for a, b in combinations(range(width), 2)}
    model.pairs = sorted(gains, key=gains.get, reverse=True)[:pairs]
    model.pair_cuts = [(cuts[a], cuts[b]) for a, b in model.pairs]
    model.pair_tables = [np.zeros((len(cuts[a]) + 1, len(cuts[b]) + 1)) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            g, h = gradient()
            step = rate * _quadrants(grid(a, b, g), grid(a, b, h), penalty)[1]
            model.pair_tables[k] += step
            margin += step[coarse[a], coarse[b]]
    return model
