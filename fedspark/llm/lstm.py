"""A bidirectional LSTM labeller in numpy: batched prediction and training."""

from __future__ import annotations

import numpy as np

HIDDEN = 20
#: Cells (sequences times steps) that are worked on at once.
CELLS = 1 << 14


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(x: np.ndarray, live: np.ndarray, wx, wh, b, keep: bool = False):
    """Hidden states (steps, sequences, HIDDEN) of one direction; states freeze where ``live`` is 0."""
    steps, n, _ = x.shape
    h = np.zeros((n, HIDDEN), dtype=np.float32)
    c = np.zeros((n, HIDDEN), dtype=np.float32)
    out = np.zeros((steps, n, HIDDEN), dtype=np.float32)
    put = (x.reshape(steps * n, -1) @ wx + b).reshape(steps, n, -1)
    tape = []
    for t in range(steps):
        z = put[t] + h @ wh
        g = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = g[:, :HIDDEN], g[:, HIDDEN : 2 * HIDDEN], g[:, 2 * HIDDEN :]
        u = np.tanh(z[:, 3 * HIDDEN :])
        on = live[t][:, None]
        c_new = f * c + i * u
        tc = np.tanh(c_new)
        if keep:
            tape.append((i, f, o, u, c, tc, h, on))
        c = on * c_new + (1 - on) * c
        h = on * (o * tc) + (1 - on) * h
        out[t] = h
    return out, tape


def _backward(x, dout, tape, wh):
    steps, n, _ = x.shape
    dwh = np.zeros_like(wh)
    dz_all = np.zeros((steps, n, 4 * HIDDEN), dtype=np.float32)
    dh, dc = np.zeros((n, HIDDEN), dtype=np.float32), np.zeros((n, HIDDEN), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, u, c, tc, h, on = tape[t]
        dh = dh + dout[t]
        d_new, dc_new = on * dh, on * dc
        do = d_new * tc
        dc_new = dc_new + d_new * o * (1 - tc * tc)
        dz = np.concatenate([dc_new * u * i * (1 - i), dc_new * c * f * (1 - f), do * o * (1 - o), dc_new * i * (1 - u * u)], axis=1)
        dz_all[t] = dz
        dwh += h.T @ dz
        dh = dz @ wh.T + (1 - on) * dh
        dc = dc_new * f + (1 - on) * dc
    flat = dz_all.reshape(steps * n, -1)
    return x.reshape(steps * n, -1).T @ flat, dwh, flat.sum(axis=0)


class Labeller:
    """``weights``: two directions (wx, wh, b) and the output layer (w, b)."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @staticmethod
    def fresh(features: int, seed: int) -> Labeller:
        r = np.random.Generator(np.random.PCG64(seed))
        w = {}
        for d in "fb":
            w[f"{d}x"] = (r.normal(size=(features, 4 * HIDDEN)) / 8).astype(np.float32)
            w[f"{d}h"] = (r.normal(size=(HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)
            w[f"{d}b"] = np.zeros(4 * HIDDEN, dtype=np.float32)
            w[f"{d}b"][HIDDEN : 2 * HIDDEN] = 1
        w["o"] = (r.normal(size=(2 * HIDDEN + features, 1)) / 8).astype(np.float32)
        w["ob"] = np.zeros(1, dtype=np.float32)
        return Labeller(w)

    def _batch(self, rows: np.ndarray, starts, sizes):
        """Padded sequences (steps, n, features), which cells are real, and their row numbers."""
        steps = int(max(sizes))
        at = np.minimum(np.arange(steps)[:, None], np.array(sizes)[None, :] - 1) + np.array(starts)[None, :]
        live = (np.arange(steps)[:, None] < np.array(sizes)[None, :]).astype(np.float32)
        return rows[at] * live[:, :, None], live, at

    def _logits(self, x, live, keep=False):
        w = self.weights
        f, tape_f = _forward(x, live, w["fx"], w["fh"], w["fb"], keep)
        b, tape_b = _forward(x[::-1], live[::-1], w["bx"], w["bh"], w["bb"], keep)
        both = np.concatenate([f, b[::-1], x], axis=2)
        return both @ w["o"] + w["ob"], both, tape_f, tape_b

    def predict(self, rows: np.ndarray, sizes: list[int]) -> np.ndarray:
        """Probability of each row; ``sizes`` are the rows of each sequence, in order."""
        out = np.zeros(len(rows), dtype=np.float32)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
        order = [i for i in np.argsort(sizes, kind="stable").tolist() if sizes[i]]
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and (hi - lo + 1) * sizes[order[hi]] <= CELLS:
                hi += 1
            pick = order[lo:hi]
            x, live, at = self._batch(rows, starts[pick], [sizes[i] for i in pick])
            p = _sigmoid(self._logits(x, live)[0][:, :, 0])
            real = live > 0
            out[at[real]] = p[real]
            lo = hi
        return out

    def train(self, rows: np.ndarray, sizes: list[int], labels: np.ndarray, epochs: int, seed: int, rate: float = 0.01, batch: int = 32) -> None:
        """Adam on the cross-entropy of all rows; batches hold sequences of like length."""
        w = self.weights
        r = np.random.Generator(np.random.PCG64(seed))
        first = {k: np.zeros_like(v) for k, v in w.items()}
        second = {k: np.zeros_like(v) for k, v in w.items()}
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
        order = np.array([i for i in np.argsort(sizes, kind="stable") if sizes[i]])
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        step = 0
        for _ in range(epochs):
            for g in r.permutation(len(groups)):
                pick = groups[g]
                x, live, at = self._batch(rows, starts[pick], [sizes[i] for i in pick])
                logits, both, tape_f, tape_b = self._logits(x, live, keep=True)
                d = (_sigmoid(logits[:, :, 0]) - labels[at]) * live / live.sum()
                d = d[:, :, None].astype(np.float32)
                dboth = d @ w["o"].T
                grad = {"o": np.einsum("tnf,tno->fo", both, d), "ob": d.sum(axis=(0, 1))}
                grad["fx"], grad["fh"], grad["fb"] = _backward(x, dboth[:, :, :HIDDEN], tape_f, w["fh"])
                grad["bx"], grad["bh"], grad["bb"] = _backward(x[::-1], dboth[::-1, :, HIDDEN : 2 * HIDDEN], tape_b, w["bh"])
                step += 1
                for k, v in grad.items():
                    v = v + 1e-4 * w[k]
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.999 * second[k] + 0.001 * v * v
                    w[k] = (w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
