"""A bidirectional gated recurrent network in numpy: training and inference.

The gates are piecewise linear (0.25 x + 0.5 between 0 and 1) and the candidate is
x / (1 + |x|): numpy computes both several times faster than exponentials. Inputs
reach a cell as rows of a table of gate inputs (one row per symbol), so a step is a
table lookup, three small products and a few element-wise operations over all
streams at once.
"""

from __future__ import annotations

import numpy as np

F4 = np.float32


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray], scale: float = 1.0) -> None:
        self.t += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads.values())))
        clip = min(1.0, 1.0 / (norm + 1e-8))
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            g = g * F4(clip)
            self.m[k] += F4(0.1) * (g - self.m[k])
            self.v[k] += F4(0.001) * (g * g - self.v[k])
            self.p[k] -= F4(self.rate * scale * fix) * self.m[k] / (np.sqrt(self.v[k]) + F4(1e-7))


def init_cell(rng: np.random.Generator, hidden: int) -> np.ndarray:
    """Recurrent weights: update, reset and candidate gates side by side."""
    return (rng.standard_normal((hidden, 3 * hidden)) * 0.5 / np.sqrt(hidden)).astype(F4)


def forward(gates: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, list]:
    """States of a run over ``gates`` (steps, streams, 3 hidden), and what ``backward`` needs."""
    steps, streams, wide = gates.shape
    n = wide // 3
    h, states, saved = np.zeros((streams, n), F4), np.empty((steps, streams, n), F4), []
    for t in range(steps):
        a = h @ u
        zr = gates[t, :, : 2 * n] + a[:, : 2 * n]
        gate = np.clip(F4(0.25) * zr + F4(0.5), 0, 1)
        z, r = gate[:, :n], gate[:, n:]
        x = gates[t, :, 2 * n :] + r * a[:, 2 * n :]
        c = x / (1 + np.abs(x))
        saved.append((h, gate, a[:, 2 * n :], x, c, (gate > 0) & (gate < 1)))
        h = h + z * (c - h)
        states[t] = h
    return states, saved


def backward(d_states: np.ndarray, u: np.ndarray, saved: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gate inputs and of the recurrent weights (backpropagation through time)."""
    steps, streams, n = d_states.shape
    d_gates, d_u, dh = np.empty((steps, streams, 3 * n), F4), np.zeros_like(u), np.zeros((streams, n), F4)
    for t in range(steps - 1, -1, -1):
        h, gate, ac, x, c, live = saved[t]
        z, r = gate[:, :n], gate[:, n:]
        dh = dh + d_states[t]
        dx = dh * z / np.square(1 + np.abs(x))
        d_zr = np.concatenate([dh * (c - h), dx * ac], axis=1) * F4(0.25) * live
        d_gates[t, :, : 2 * n], d_gates[t, :, 2 * n :] = d_zr, dx
        da = np.concatenate([d_zr, dx * r], axis=1)
        d_u += h.T @ da
        dh = dh * (1 - z) + da @ u.T
    return d_gates, d_u


class Runner:
    """Inference over many streams: a table of gate inputs, one row per symbol.

    ``starts`` more rows behind the table's own repeat them with the update gate
    open and the reset gate shut: a symbol with that offset forgets what came before.
    """

    def __init__(self, table: np.ndarray, u: np.ndarray):
        n = u.shape[0]
        z, r, c = (np.ascontiguousarray(table[:, i * n : (i + 1) * n]) for i in range(3))
        z, r = F4(0.25) * z + F4(0.5), F4(0.25) * r + F4(0.5)
        self.z, self.r, self.c = (np.concatenate(x) for x in ((z, np.full_like(z, 9)), (r, np.full_like(r, -9)), (c, c)))
        self.uz, self.ur, self.uc = (np.ascontiguousarray(u[:, i * n : (i + 1) * n] * F4(s)) for i, s in enumerate((0.25, 0.25, 1)))
        self.n, self.symbols = n, len(table)

    def begin(self, streams: int) -> None:
        self.h = np.zeros((streams, self.n), F4)
        self.a, self.b, self.x, self.y, self.zero = (np.zeros_like(self.h) for _ in range(5))
        self.one = np.ones_like(self.h)

    def step(self, ids: np.ndarray) -> np.ndarray:
        h, a, b, x, y = self.h, self.a, self.b, self.x, self.y
        self.z.take(ids, axis=0, out=a, mode="clip")
        np.matmul(h, self.uz, out=b)
        a += b
        np.maximum(a, self.zero, out=a)
        np.minimum(a, self.one, out=a)
        self.r.take(ids, axis=0, out=x, mode="clip")
        np.matmul(h, self.ur, out=b)
        x += b
        np.maximum(x, self.zero, out=x)
        np.minimum(x, self.one, out=x)
        np.matmul(h, self.uc, out=b)
        x *= b
        self.c.take(ids, axis=0, out=b, mode="clip")
        x += b
        np.abs(x, out=y)
        y += self.one
        x /= y
        x -= h
        x *= a
        h += x
        return h


def lay_out(ids: np.ndarray, streams: int, context: int, fill: int) -> tuple[np.ndarray, int]:
    """Cut ``ids`` into equal streams, each with ``context`` symbols before and behind it.

    Returns (steps, streams) and the number of steps that are a stream's own.
    """
    own = -(-len(ids) // streams)
    padded = np.full(own * streams + 2 * context, fill, ids.dtype)
    padded[context : context + len(ids)] = ids
    view = np.lib.stride_tricks.sliding_window_view(padded, own + 2 * context)[::own]
    return np.ascontiguousarray(view[:streams].T), own
