"""Log-bilinear model of the next symbol after two symbols, trained by noise-contrastive estimation.

The two symbols before add up a vector each, h = A[v] + B[u]; the score of w is h . Q[w] + b[w].
Training tells true symbols from noise drawn by their share, without normalising. For scoring, the
sum over all symbols is a matrix product, because the score of w is one term of (v, w) plus one of
(u, w): Z = exp(A Q') diag(exp b) exp(B Q')'. All log-probabilities are then table look-ups.
"""

from __future__ import annotations

import numpy as np

WIDTH = 16
NOISE = 32
BATCH = 4096


def start(counts: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Small random vectors; with the biases alone the model is the symbols' shares."""
    rng = np.random.default_rng(seed)
    table = lambda: rng.normal(0, 0.1, (len(counts), WIDTH)).astype(np.float32)
    return {"a": table(), "b": table(), "q": table(), "bias": np.log(counts / counts.sum()).astype(np.float32)}


def _row_sums(rows: np.ndarray, grads: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(rows, kind="stable")
    ranked = rows[order]
    first = np.flatnonzero(np.concatenate([[True], np.diff(ranked) != 0]))
    return ranked[first], np.add.reduceat(grads[order], first, axis=0)


class Trainer:
    """Adagrad steps over batches of (v, u, w): the symbol before, the one before that, the true one."""

    def __init__(self, model: dict[str, np.ndarray], counts: np.ndarray, seed: int, rate: float = 0.08):
        self.m = {k: v.copy() for k, v in model.items()}
        self.past = {k: np.full(v.shape, 1e-2, np.float32) for k, v in model.items()}
        share = counts / counts.sum()
        self.log_noise = np.log(NOISE * share).astype(np.float32)
        self.cumulated = np.cumsum(share)
        self.rng, self.rate, self.seen = np.random.default_rng(seed), rate, 0

    def _move(self, name: str, rows: np.ndarray, grads: np.ndarray) -> None:
        rows, grads = _row_sums(rows, grads, len(self.m[name]))
        self.past[name][rows] += grads**2
        self.m[name][rows] += self.rate * grads / np.sqrt(self.past[name][rows])

    def learn(self, v: np.ndarray, u: np.ndarray, w: np.ndarray) -> None:
        for at in range(0, len(w), BATCH):
            self._batch(v[at : at + BATCH], u[at : at + BATCH], w[at : at + BATCH])
        self.seen += len(w)

    def _batch(self, v: np.ndarray, u: np.ndarray, w: np.ndarray) -> None:
        m, n = self.m, len(w)
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), len(self.cumulated) - 1)
        h, q = m["a"][v] + m["b"][u], m["q"][w]
        true = np.einsum("ij,ij->i", h, q) + m["bias"][w] - self.log_noise[w]
        false = h @ m["q"][noise].T + (m["bias"] - self.log_noise)[noise]
        miss = 1 / (1 + np.exp(np.clip(true, -30, 30)))
        wrong = 1 / (1 + np.exp(-np.clip(false, -30, 30)))
        scale = np.float32(1 / np.sqrt(n))
        to_h = (miss[:, None] * q - wrong @ m["q"][noise]) * scale
        self._move("q", np.concatenate([w, noise]), np.concatenate([miss[:, None] * h, -(wrong.T @ h)]) * scale)
        self._move("bias", np.concatenate([w, noise]), np.concatenate([miss, -wrong.sum(0)]) * scale)
        self._move("a", v, to_h)
        self._move("b", u, to_h)


def tables(model: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(of v and w, of u and w, of v and u): their sum, minus the last, is the log-probability of w."""
    one = model["a"] @ model["q"].T + model["bias"]
    two = model["b"] @ model["q"].T
    top1, top2 = one.max(1, keepdims=True), two.max(1, keepdims=True)
    total = np.exp(one - top1) @ np.exp(two - top2).T
    return one, two, np.log(total) + top1 + top2.T


def log_probabilities(look: tuple[np.ndarray, np.ndarray, np.ndarray], v: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
    one, two, total = look
    return one[v, w].astype(float) + two[u, w] - total[v, u]
