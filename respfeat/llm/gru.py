"""A gated recurrent language model in numpy: class-factored softmax, truncated
backpropagation, state carried across windows."""

from __future__ import annotations

import numpy as np

#: Steps of a window: gradients run back this far, the state runs on. Scoring needs no gradients and takes longer windows.
WINDOW, SCORED = 16, 128
#: Rows of a scoring window, which holds a few arrays of rows x classes.
SCORED_ROWS = 16_384
#: Longer documents are learned from in stretches of so many tokens, each from an empty state.
STRETCH = 512
#: ``exp`` of less than minus this is taken for 0; single precision goes to -87.
_RANGE = 80
F32 = np.float32


class Shape:
    """Ids are dealt into classes of equal width, so that P(id) = P(class) P(id | class)."""

    def __init__(self, ids: int, hidden: int) -> None:
        self.hidden = hidden
        self.width = max(1, int(np.ceil(np.sqrt(ids))))
        self.classes = -(-ids // self.width)
        self.ids = self.classes * self.width
        h, c, w = hidden, self.classes, self.width
        #: The gates' input side per previous id (the last row is the start), the recurrent side, both outputs.
        self.parts = {"inp": (self.ids + 1, 3 * h), "rec": (h, 3 * h), "wc": (h, c), "bc": (c,), "wi": (c, h, w), "bi": (c, w)}
        self.size = sum(int(np.prod(s)) for s in self.parts.values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, s in self.parts.items():
            n = int(np.prod(s))
            out[name] = flat[at : at + n].reshape(s)
            at += n
        return out

    def initial(self, counts: np.ndarray) -> np.ndarray:
        """Small random weights; biases of the unigram distribution of ``counts``."""
        rng = np.random.default_rng(7)
        flat = (rng.standard_normal(self.size) * 0.1).astype(F32)
        p = self.views(flat)
        mass = np.full(self.ids, 1e-2)
        mass[: len(counts)] += counts
        mass = mass.reshape(self.classes, self.width)
        p["bc"][:] = np.log(mass.sum(axis=1) / mass.sum())
        p["bi"][:] = np.log(mass / mass.sum(axis=1, keepdims=True))
        p["wc"][:] *= 0.1
        p["wi"][:] *= 0.1
        return flat


def _output(w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, bool]:
    """(weights with the biases as last row, less the most that a logit can be; whether each row of logits has one
    that ``exp`` does not take to 0). States lie in [-1, 1], which bounds logits, so rows need no maxima of their own."""
    reach = np.abs(w).sum(axis=-2)
    top = (b + reach).max(axis=-1, keepdims=True)
    near = bool(((b - reach).max(axis=-1) - top[..., 0] > -_RANGE).all())
    return np.concatenate([w, (b - top)[..., None, :]], axis=-2), near


def _back(w: np.ndarray) -> np.ndarray:
    """Weights that lead back from logits, with a last column of ones, which gives the sums of rows."""
    return np.ascontiguousarray(np.concatenate([w, np.ones_like(w[..., :1, :])], axis=-2).swapaxes(-1, -2))


def _sums(rows: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin there. Most ids stand alone in a window, so only the others are summed."""
    out, wide = rows.take(firsts, axis=0), np.diff(firsts, append=len(rows))
    many = np.flatnonzero(wide > 1)
    if len(many):
        wide = wide[many]
        starts = np.cumsum(wide) - wide
        at = np.arange(int(wide.sum())) + np.repeat(firsts[many] - starts, wide)
        out[many] = np.add.reduceat(rows.take(at, axis=0), starts, axis=0)
    return out


def _exp(x: np.ndarray, near: bool) -> np.ndarray:
    """Uses up x, one row of logits after another, each up to a constant of its own."""
    if not near:
        x -= x.max(axis=1, keepdims=True)
    return np.exp(x, out=x)


def _steps(p: dict, shape: Shape, before: np.ndarray, sizes: list[int], h: np.ndarray):
    """Runs the cell over a window. before: previous ids, step after step; sizes: how many
    sequences, the first ones, are still there at each step. Changes h to the last states.
    Gives the states and what gradients need, all with units as rows, since these are long."""
    k, rec, now = shape.hidden, np.ascontiguousarray(p["rec"].T), np.ascontiguousarray(h.T)
    gates = np.ascontiguousarray(p["inp"].take(before, axis=0).T)
    # The logistic function of x is (1 + tanh(x / 2)) / 2.
    gates[: 2 * k] *= F32(0.5)
    rec[: 2 * k] *= F32(0.5)
    out, old, un = (np.empty((k, len(before)), F32) for _ in range(3))
    at = 0
    for n in sizes:
        here = slice(at, at + n)
        last, x = now[:, :n], gates[:, here]
        old[:, here] = last
        u = rec @ last
        zr, cand = x[: 2 * k], x[2 * k :]
        zr += u[: 2 * k]
        np.tanh(zr, out=zr)
        zr += 1
        zr *= F32(0.5)
        un[:, here] = u[2 * k :]
        u = u[2 * k :]
        u *= zr[k:]
        cand += u
        np.tanh(cand, out=cand)
        last -= cand
        last *= zr[:k]
        last += cand
        out[:, here] = last
        at += n
    h[:] = now.T
    return out, (old, gates[:k], gates[k : 2 * k], un, gates[2 * k :])


def _order(ids: np.ndarray, shape: Shape):
    """Rows by id, and so by class: (order, ids in this order, [(class, first row, behind the last)])."""
    order = np.argsort(ids.astype(np.int16) if shape.ids < 2**15 else ids, kind="stable")
    own = ids[order]
    edges = np.searchsorted(own, np.arange(shape.classes + 1) * shape.width).tolist()
    return order, own, [(c, lo, hi) for c, (lo, hi) in enumerate(zip(edges, edges[1:])) if lo < hi]


def _states(out: np.ndarray, order: np.ndarray) -> np.ndarray:
    """States as rows in this order, with a last column of ones, which meets the biases."""
    return np.concatenate([out, np.ones((1, out.shape[1]), F32)]).T.take(order, axis=0)


def _inner(states: np.ndarray, w: np.ndarray, runs: list) -> np.ndarray:
    """Logits within the classes of rows that are sorted by class."""
    x = np.empty((len(states), w.shape[2]), w.dtype)
    for c, lo, hi in runs:
        np.matmul(states[lo:hi], w[c], out=x[lo:hi])
    return x


def window_log10(p: dict, shape: Shape, before: np.ndarray, ids: np.ndarray, sizes: list[int], h: np.ndarray) -> np.ndarray:
    """log10 P of each id."""
    out, _ = _steps(p, shape, before, sizes, h)
    order, own, runs = _order(ids, shape)
    states, at = _states(out, order), np.arange(len(ids))
    outer, near = _output(p["wc"], p["bc"])
    x = states @ outer
    if not near:
        x -= x.max(axis=1, keepdims=True)
    found = x[at, own // shape.width] - _log_sum(x)
    outer, near = _output(p["wi"], p["bi"])
    x = _inner(states, outer, runs)
    if not near:
        x -= x.max(axis=1, keepdims=True)
    found += x[at, own % shape.width] - _log_sum(x)
    total = np.empty(len(ids))
    total[order] = found
    return total / np.log(10)


def _log_sum(x: np.ndarray) -> np.ndarray:
    """Uses up x."""
    return np.log(np.exp(x, out=x) @ np.ones(x.shape[1], F32))


def window_gradient(p: dict, shape: Shape, before: np.ndarray, ids: np.ndarray, sizes: list[int], h: np.ndarray, g: dict) -> None:
    """Adds the gradient of the window's mean negative log-likelihood to g; changes h."""
    k, n_all = shape.hidden, F32(len(ids))
    out, kept = _steps(p, shape, before, sizes, h)
    order, own, runs = _order(ids, shape)
    states = _states(out, order)
    cls = own // shape.width
    # Gradients of logits are probabilities, less 1 at the id. The first part goes by matrices, divided by the sums of
    # their rows on the side that is narrow; the second by sums of the states per class and id.
    weights, near = _output(p["wc"], p["bc"])
    e = _exp(states @ weights, near)
    back = e @ _back(p["wc"])
    share = 1 / (n_all * back[:, k:])
    part = (states * share).T @ e
    dh = back[:, :k] * share
    firsts = np.flatnonzero(np.diff(own, prepend=-1))
    by_id, at = _sums(states, firsts) / n_all, own[firsts]
    here = np.flatnonzero(np.diff(cls[firsts], prepend=-1))
    part[:, cls[firsts[here]]] -= np.add.reduceat(by_id, here, axis=0).T
    g["wc"] += part[:k]
    g["bc"] += part[k]
    weights, near = _output(p["wi"], p["bi"])
    e = _exp(_inner(states, weights, runs), near)
    weights = _back(p["wi"])
    for c, lo, hi in runs:
        np.matmul(e[lo:hi], weights[c], out=back[lo:hi])
    share = 1 / (n_all * back[:, k:])
    dh += back[:, :k] * share
    scaled, part = states * share, np.zeros((shape.classes, k + 1, shape.width), F32)
    for c, lo, hi in runs:
        np.matmul(scaled[lo:hi].T, e[lo:hi], out=part[c])
    g["wi"] += part[:, :k]
    g["bi"] += part[:, k]
    # What the weights of class and id say together, for each id.
    each = p["wi"].transpose(0, 2, 1) + p["wc"].T[:, None]
    dh -= each.reshape(-1, k).take(own, axis=0) / n_all
    g["wi"].transpose(0, 2, 1)[at // shape.width, at % shape.width] -= by_id[:, :k]
    g["bi"].reshape(-1)[at] -= by_id[:, k]
    dh_out = np.empty((k, len(ids)), F32)
    dh_out[:, order] = dh.T
    # The gates' gradients are these factors times that of the state.
    old, z, r, un, cand = kept
    new = (1 - z) * (1 - cand * cand)
    factors = np.stack([(old - cand) * z * (1 - z), new * un * r * (1 - r), new])
    through = np.stack([factors[0], factors[1], new * r])
    rec, carry, at = p["rec"], np.zeros((k, sizes[0]), F32), len(before)
    for n in reversed(sizes):
        at -= n
        here = slice(at, at + n)
        d = dh_out[:, here]
        d += carry[:, :n]
        np.matmul(rec, (through[:, :, here] * d).reshape(3 * k, n), out=carry[:, :n])
        carry[:, :n] += d * z[:, here]
    g["rec"] += old @ (through * dh_out).reshape(3 * k, -1).T
    d_gates = (factors * dh_out).reshape(3 * k, -1).T
    # Sums per previous id, by sorting.
    by = np.argsort(before.astype(np.int16) if shape.ids < 2**15 else before, kind="stable")
    own = before.take(by)
    firsts = np.flatnonzero(np.diff(own, prepend=-1))
    g["inp"][own[firsts]] += _sums(np.ascontiguousarray(d_gates).take(by, axis=0), firsts)


def windows(docs: list[np.ndarray], shape: Shape, group: int, steps: int, rows: int | None = None):
    """Cuts documents, in groups of similar length, into windows of so many steps, and of so many rows if the
    group allows: (rows, before, ids, sizes, is a new group). Rows are the documents' places, step after step."""
    by_length = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    for lo in range(0, len(docs), group):
        own = by_length[lo : lo + group]
        lengths = np.array([len(docs[i]) for i in own])
        flat = np.concatenate([docs[i] for i in own])
        starts = np.cumsum(lengths) - lengths
        own = np.array(own)
        t = 0
        while t < lengths[0]:
            active = int(np.searchsorted(-lengths, -t, side="left"))
            end = min(t + (steps if rows is None else max(1, min(steps, rows // active))), int(lengths[0]))
            sizes = [int(np.searchsorted(-lengths, -s, side="left")) for s in range(t, end)]
            at = np.concatenate([starts[:n] + t + j for j, n in enumerate(sizes)])
            ids = flat[at]
            before = flat[np.maximum(at - 1, 0)].copy()
            if t == 0:
                before[: sizes[0]] = shape.ids
            yield np.concatenate([own[:n] for n in sizes]), before, ids, sizes, t == 0
            t = end


def train(flat: np.ndarray, shape: Shape, docs: list[np.ndarray], group: int, rate: float) -> int:
    """One pass of Adagrad over the documents; changes flat. Gives the number of tokens seen."""
    p, g = shape.views(flat), np.zeros_like(flat)
    grads, seen, h = shape.views(g), 0, None
    square, step = np.full_like(flat, 1e-4), np.empty_like(flat)
    parts = [d[k : k + STRETCH] for d in docs for k in range(0, len(d), STRETCH)]
    for _, before, ids, sizes, first in windows(parts, shape, group, WINDOW):
        if first:
            h = np.zeros((sizes[0], shape.hidden), F32)
        g[:] = 0
        window_gradient(p, shape, before, ids, sizes, h, grads)
        square += np.multiply(g, g, out=step)
        # A window of few tokens is a small step.
        g *= F32(rate * min(1.0, len(ids) / 1024))
        g /= np.sqrt(square, out=step)
        flat -= g
        seen += len(ids)
    return seen


def score(flat: np.ndarray, shape: Shape, docs: list[np.ndarray], group: int) -> np.ndarray:
    """log10 P of each document."""
    p, out, h = shape.views(flat), np.zeros(len(docs)), None
    for rows, before, ids, sizes, first in windows(docs, shape, group, SCORED, SCORED_ROWS):
        if first:
            h = np.zeros((sizes[0], shape.hidden), F32)
        out += np.bincount(rows, window_log10(p, shape, before, ids, sizes, h), minlength=len(docs))
    return out
