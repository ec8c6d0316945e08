"""Bidirectional LSTM that labels the blocks of a page, in numpy."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def start(width: int, hidden: int = 24, seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {"e": rng.normal(0, (1 / width) ** 0.5, (width, hidden)), "c": np.zeros(hidden)}
    for d in ("f", "b"):
        p["w" + d] = rng.normal(0, (0.5 / hidden) ** 0.5, (2 * hidden, 4 * hidden))
        p["v" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])  # gates: in, keep, out, new
    p |= {"o": rng.normal(0, 0.3, 2 * hidden), "s": np.zeros(1)}
    return {k: v.astype(np.float32) for k, v in p.items()}


def _run(z: np.ndarray, mask: np.ndarray, w: np.ndarray, v: np.ndarray, back: bool) -> tuple[np.ndarray, list]:
    """States of one direction over (time, page, unit); padded steps keep the state."""
    t, b, h = z.shape
    state, cell = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
    out, tape = np.zeros((t, b, h), np.float32), []
    for i in range(t - 1, -1, -1) if back else range(t):
        both = np.concatenate([z[i], state], axis=1)
        g = both @ w + v
        gate, new = _sigmoid(g[:, : 3 * h]), np.tanh(g[:, 3 * h :])
        c = gate[:, h : 2 * h] * cell + gate[:, :h] * new
        tc = np.tanh(c)
        m = mask[i][:, None]
        tape.append((i, both, gate, new, cell, tc, m))
        cell = m * c + (1 - m) * cell
        state = m * gate[:, 2 * h :] * tc + (1 - m) * state
        out[i] = state
    return out, tape


def _unwind(dout: np.ndarray, tape: list, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t, b, h = dout.shape
    dz, dw, dv = np.zeros_like(dout), np.zeros_like(w), np.zeros(w.shape[1], np.float32)
    ds, dc = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
    for i, both, gate, new, cell, tc, m in reversed(tape):
        d = ds + dout[i]
        inner, ds_keep, dc_keep = d * m, d * (1 - m), dc * (1 - m)
        dc_in = dc * m + inner * gate[:, 2 * h :] * (1 - tc**2)
        dg = np.concatenate([dc_in * new, dc_in * cell, inner * tc], axis=1) * gate * (1 - gate)
        dg = np.concatenate([dg, dc_in * gate[:, :h] * (1 - new**2)], axis=1)
        dw += both.T @ dg
        dv += dg.sum(0)
        dboth = dg @ w.T
        dz[i] = dboth[:, :h]
        ds = dboth[:, h:] + ds_keep
        dc = dc_in * gate[:, h : 2 * h] + dc_keep
    return dz, dw, dv


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(map(len, pages))
    x, mask = np.zeros((t, len(pages), pages[0].shape[1]), np.float32), np.zeros((t, len(pages)), np.float32)
    for j, p in enumerate(pages):
        x[: len(p), j], mask[: len(p), j] = p, 1
    return x, mask


def forward(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray):
    z = np.tanh(x @ p["e"] + p["c"])
    f, tape_f = _run(z, mask, p["wf"], p["vf"], False)
    b, tape_b = _run(z, mask, p["wb"], p["vb"], True)
    h = np.concatenate([f, b], axis=2)
    return _sigmoid(h @ p["o"] + p["s"]), (z, h, tape_f, tape_b)


def fit(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 10, batch: int = 32, rate: float = 0.006, seed: int = 12) -> dict[str, np.ndarray]:
    """Cross-entropy over all blocks, by Adam; pages of like length share a batch."""
    p = start(pages[0].shape[1])
    m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    rng = np.random.default_rng(seed)
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    for _ in range(epochs):
        for at in rng.permutation(range(0, len(order), batch)):
            chosen = order[at : at + batch]
            x, mask = padded([pages[i] for i in chosen])
            y = padded([labels[i][:, None].astype(np.float32) for i in chosen])[0][:, :, 0]
            q, (z, h, tape_f, tape_b) = forward(p, x, mask)
            d = (q - y) * mask / mask.sum()
            g = {"o": np.einsum("tb,tbh->h", d, h), "s": d.sum(keepdims=True)[0]}
            dh = d[:, :, None] * p["o"]
            n = h.shape[2] // 2
            zf, g["wf"], g["vf"] = _unwind(dh[:, :, :n], tape_f, p["wf"])
            zb, g["wb"], g["vb"] = _unwind(dh[:, :, n:], tape_b, p["wb"])
            dz = (zf + zb) * (1 - z**2)
            g["e"], g["c"] = np.einsum("tbi,tbh->ih", x, dz, optimize=True), dz.sum((0, 1))
            t += 1
            norm = min(1.0, 1.0 / (float(np.sqrt(sum((a**2).sum() for a in g.values()))) + 1e-9))
            for k, a in g.items():
                a = a * norm
                m[k] = 0.9 * m[k] + 0.1 * a
                v[k] = 0.999 * v[k] + 0.001 * a * a
                p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return p


def predict(p: dict[str, np.ndarray], pages: list[np.ndarray], batch: int = 128) -> list[np.ndarray]:
    """Probability of each block of each page, pages of like length together."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        size = max(1, min(batch, 40_000 // len(pages[order[min(at + batch, len(order)) - 1]])))  # few at once where they are long
        chosen = order[at : at + size]
        x, mask = padded([pages[i] for i in chosen])
        q, _ = forward(p, x, mask)
        for j, i in enumerate(chosen):
            out[i] = q[: len(pages[i]), j]
        at += size
    return out
