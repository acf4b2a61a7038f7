"""A gated recurrent language model in numpy, with a class-factored output.

Symbols are words and tail classes. A word's probability is that of its class times
that of the word within the class, both softmaxes over the recurrent state; a tail
class has no words here, its probability is what the model gives. A step costs the
classes and the words of one class, not the vocabulary.

The recurrent state is carried from window to window, in training and in scoring, and
starts anew with each document. Training is backpropagation truncated at a window's
start, by Adam, in a fixed order. Documents run side by side in lanes, each lane one
document behind another. The weights pack into bytes, so that models fitted on parts of
the data can be averaged.
"""

from __future__ import annotations

import copy
import functools
import heapq

import numpy as np

HIDDEN, WINDOW, LANES = 16, 16, 512
#: Training: lanes, steps of a window, epochs, rate; unless the caller says otherwise.
TRAIN_LANES, TRAIN_WINDOW, EPOCHS, RATE = 64, 16, 2, 0.01
#: Weights that a step of the training changes at once.
_PART = 1 << 13


class Lanes:
    """Sequences dealt into lanes, one behind another: steps of all lanes of a window at once."""

    def __init__(self, lengths: np.ndarray, lanes: int):
        self.lanes: list[list[int]] = [[] for _ in range(max(1, min(lanes, len(lengths))))]
        load = [(0, i) for i in range(len(self.lanes))]
        for d in np.argsort(-lengths, kind="stable").tolist():  # the longest first, each to the shortest lane
            if lengths[d]:
                size, lane = heapq.heappop(load)
                self.lanes[lane].append(d)
                heapq.heappush(load, (size + int(lengths[d]), lane))
        first = np.cumsum(lengths) - lengths
        size = np.array([int(lengths[lane].sum()) if lane else 0 for lane in self.lanes])
        self.lanes = [self.lanes[i] for i in np.argsort(-size, kind="stable")]  # those that end last are in front
        self.size = -np.sort(-size)
        parts = [np.arange(first[d], first[d] + lengths[d]) for lane in self.lanes for d in lane]
        self.order = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size

    def windows(self, steps: int):
        """Places (of the tokens) in windows, a list of steps each; lanes that have ended are at the end."""
        longest = int(self.size[0]) if len(self.size) else 0
        going = np.searchsorted(-self.size, -np.arange(longest), side="left").tolist()  # lanes that have a step k
        for t in range(0, longest, steps):
            yield [self.order[self.start[:going[k]] + k] for k in range(t, min(t + steps, longest))]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Of -x, in place; overflow gives 0."""
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _exp(x: np.ndarray, bounded: bool) -> np.ndarray:
    """Exponentials, in place; the greatest of a row comes off first unless all are ``bounded``."""
    if not bounded:
        x -= x.max(axis=1, keepdims=True)
    return np.exp(x, out=x)


def _flat(arrays: dict) -> tuple[np.ndarray, dict]:
    """The numbers of all arrays in one, and its parts in their shapes."""
    flat = np.concatenate([v.ravel() for v in arrays.values()])
    edge = np.cumsum([v.size for v in arrays.values()])[:-1]
    return flat, {k: x.reshape(v.shape) for (k, v), x in zip(arrays.items(), np.split(flat, edge))}


@functools.cache
def _ones(n: int, dtype) -> np.ndarray:
    return np.ones(n, dtype=dtype)


def _sums(x: np.ndarray) -> np.ndarray:
    return x @ _ones(x.shape[1], x.dtype)


def _log_chance(x: np.ndarray, chosen: np.ndarray, bounded: bool = False) -> np.ndarray:
    """Log softmax of one column per row."""
    if not bounded:
        x -= x.max(axis=1, keepdims=True)
    taken = x.ravel().take(np.arange(0, x.size, x.shape[1]) + chosen)
    return taken - np.log(_sums(_exp(x, True)))


def _softmax_error(x: np.ndarray, chosen: np.ndarray, bounded: bool) -> np.ndarray:
    """Softmax less one in the chosen columns, in place."""
    e = _exp(x, bounded)
    e *= np.reciprocal(_sums(e))[:, None]
    e[np.arange(len(x)), chosen] -= 1
    return e


def _logits(s: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = s @ w
    x += b
    return x


class Gru:
    """``edges``: class c of the words holds the symbols edges[c] .. edges[c+1]; ``tails`` classes
    without words follow. ``counts`` (of all symbols) set the biases to the unigram model."""

    def __init__(self, edges: np.ndarray, tails: int, counts: np.ndarray, hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        words, n = int(edges[-1]), len(edges) - 1 + tails
        self.edges, self.words, self.hidden = edges, words, hidden
        self.class_of = np.concatenate([np.repeat(np.arange(len(edges) - 1), np.diff(edges)), np.arange(len(edges) - 1, n)])
        if words + tails < 1 << 15:
            self.class_of = self.class_of.astype(np.int16)  # a type of few bytes, which numpy sorts by radix
        of_class = np.bincount(self.class_of, counts, minlength=n)

        def normal(*shape):
            return rng.normal(0, 0.1, shape).astype(np.float32)

        self.weights = {"x": normal(words + tails, 3 * hidden), "u": normal(hidden, 3 * hidden),
                        "c": normal(hidden, n), "cb": np.log(of_class + 1).astype(np.float32),
                        "w": normal(words, hidden), "wb": np.log(counts[:words] + 1).astype(np.float32)}

    def packed(self) -> bytes:
        return b"".join(self.weights[k].astype("<f4").tobytes() for k in sorted(self.weights))

    def with_weights(self, packed: bytes) -> "Gru":
        """A model of the same symbols with other weights."""
        other, flat, at = copy.copy(self), np.frombuffer(packed, "<f4"), 0
        other.weights = {}
        for k in sorted(self.weights):
            old = self.weights[k]
            other.weights[k] = flat[at:at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
        return other

    def _bounded(self) -> bool:
        """Whether no exponential of a logit or sum of some overflows or vanishes in floats; a state lies in -1 .. 1."""
        w = self.weights
        return all(float((np.abs(m).sum(axis=axis) + np.abs(b)).max(initial=0)) < 60
                   for m, b, axis in ((w["c"], w["cb"], 0), (w["w"], w["wb"], 1)))

    def _scaled(self):
        """The weights of the steps times -1 (gates) and -2 (candidate), as their exponentials take them; exact in floats.
        By symbol and gate, and by gate; the numbers of a gate lie together, as slices of a few columns are slow to go through."""
        by = np.array([-1, -1, -2], dtype=np.float32)[:, None, None]
        x, u = (np.multiply(self.weights[k].reshape(-1, 3, self.hidden).swapaxes(0, 1), by, order="C") for k in ("x", "u"))
        return x.swapaxes(0, 1), u

    def _step(self, h, x, weights):
        """``x`` and ``weights`` as of :meth:`_scaled`."""
        u, x = np.matmul(h, weights), x.swapaxes(0, 1)
        zr = u[:2]
        zr += x[:2]
        _sigmoid(zr)
        n = zr[1] * u[2]
        n += x[2]
        _sigmoid(n)
        n *= 2
        n -= 1  # tanh
        following = h - n
        following *= zr[0]
        following += n
        return following, (zr, n, u[2])

    def _states(self, h, window, before, fresh, scaled, keep: list | None = None):
        """(state behind the window, states of all its tokens); ``keep`` takes what the way back needs."""
        at = np.concatenate(window)
        x, starts = scaled[0].swapaxes(0, 1).take(before[at], axis=1).swapaxes(0, 1), fresh[at]
        edge = np.cumsum([0, *map(len, window)])
        some = np.add.reduceat(starts, edge[:-1], dtype=np.int64).tolist()
        out = np.empty((len(at), self.hidden), dtype=np.float32)
        for a, b, new in zip(edge.tolist(), edge[1:].tolist(), some):
            if len(h) < b - a:
                h = np.zeros((b - a, self.hidden), dtype=np.float32)
            elif len(h) > b - a:
                h = h[:b - a]
            if new:
                h = h * ~starts[a:b, None]
            following, parts = self._step(h, x[a:b], scaled[1])
            if keep is not None:
                keep.append((h, *parts))
            out[a:b] = h = following
        return h, out, at

    def _by_class(self, symbols: np.ndarray):
        """(order of the symbols by their classes; first and end symbol of a class of more than one word, and its part
        of that order)."""
        of = self.class_of[symbols]
        order = np.argsort(of, kind="stable")
        edge, first = np.searchsorted(of[order], np.arange(len(self.edges))).tolist(), self.edges.tolist()
        return order, [(first[c], first[c + 1], slice(a, b)) for c, (a, b) in enumerate(zip(edge, edge[1:]))
                       if b > a and first[c + 1] - first[c] > 1]  # else the chance is 1, whatever the weights

    @np.errstate(over="ignore")
    def log_likelihood(self, symbols: np.ndarray, lengths: np.ndarray, begin: int) -> np.ndarray:
        """Natural log probability of every token of whole documents that lie back to back;
        a document's first token follows ``begin``."""
        w, out, bounded = self.weights, np.zeros(len(symbols)), self._bounded()
        before, fresh = _inputs(symbols, lengths, begin)
        h, scaled = np.zeros((0, self.hidden), dtype=np.float32), self._scaled()
        for window in Lanes(lengths, LANES).windows(WINDOW):
            h, s, at = self._states(h, window, before, fresh, scaled)
            target = symbols[at]
            p = _log_chance(_logits(s, w["c"], w["cb"]), self.class_of[target], bounded)
            order, classes = self._by_class(target)
            s, target, p = s.take(order, axis=0), target[order], p[order]
            for a, b, rows in classes:
                p[rows] += _log_chance(_logits(s[rows], w["w"][a:b].T, w["wb"][a:b]), target[rows] - a, bounded)
            out[at[order]] = p
        return out

    @np.errstate(over="ignore")
    def fit(self, symbols: np.ndarray, lengths: np.ndarray, begin: int, epochs: int = EPOCHS, rate: float = RATE,
            lanes: int = TRAIN_LANES) -> None:
        before, fresh = _inputs(symbols, lengths, begin)
        flat, self.weights = _flat(self.weights)
        (g, grads), mean, square = _flat(self.weights), np.zeros_like(flat), np.zeros_like(flat)
        # parts that stay in the processor's cache
        parts = [[x[i:i + _PART] for x in (flat, g, mean, square)] for i in range(0, len(flat), _PART)]
        first, second = (np.empty(min(_PART, len(flat)), dtype=flat.dtype) for _ in range(2))
        change = np.empty(len(first))
        windows = list(Lanes(lengths, lanes).windows(TRAIN_WINDOW))
        total, t = epochs * len(windows), 0
        for _ in range(epochs):
            h = np.zeros((0, self.hidden), dtype=np.float32)
            for window in windows:
                g[:] = 0
                h, _ = self._gradients(h, window, symbols, before, fresh, grads)
                t += 1
                step = rate * (1 - 0.9 * t / total) * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
                for w, x, m, v in parts:
                    a, b, c = first[:len(w)], second[:len(w)], change[:len(w)]
                    m += np.multiply(0.1, np.subtract(x, m, out=a), out=a)
                    v += np.multiply(0.001, np.subtract(np.multiply(x, x, out=a), v, out=a), out=a)
                    np.sqrt(v, out=b)
                    b += 1e-8
                    np.multiply(step, m, out=c)  # in doubles, as the step is
                    c /= b
                    w -= c

    def _gradients(self, h, window, symbols, before, fresh, g: dict | None = None):
        """The state behind a window, and the gradients of its mean negative log likelihood (in ``g``, arrays of zeros)."""
        w, d = self.weights, self.hidden
        kept: list = []
        h, s, at = self._states(h, window, before, fresh, self._scaled(), kept)
        target, n = symbols[at], np.float32(len(at))
        g = g or {k: np.zeros_like(v) for k, v in w.items()}
        bounded, some = self._bounded(), s / n  # the mean's share of each token
        # class softmax
        e = _softmax_error(_logits(s, w["c"], w["cb"]), self.class_of[target], bounded)
        g["c"][:], g["cb"][:], ds = some.T @ e, _sums(e.T) / n, e @ w["c"].T
        order, classes = self._by_class(target)
        s, some, target, error = s.take(order, axis=0), some.take(order, axis=0), target[order], ds.take(order, axis=0)
        for a, b, rows in classes:
            own = w["w"][a:b]
            e = _softmax_error(_logits(s[rows], own.T, w["wb"][a:b]), target[rows] - a, bounded)
            g["w"][a:b], g["wb"][a:b] = e.T @ some[rows], _sums(e.T) / n
            error[rows] += e @ own
        ds[order] = error
        ds /= n
        # back through the steps; lanes that have ended send nothing back
        old, (z, r), cand, un = (np.concatenate(x, axis=-2) for x in zip(*kept))
        of_n = (1 - z) * (1 - cand * cand)  # what a state's error is worth to each gate
        of_z = (old - cand) * z * (1 - z)
        un *= np.float32(-0.5)  # as it is without the scale
        of_r = of_n * un * r * (1 - r)
        of = np.concatenate([of_z, of_r, of_n * r], axis=1)
        inner, u_back = np.empty_like(of), w["u"].T.copy()
        edge, back, stops = np.cumsum([0, *map(len, window)]).tolist(), np.zeros((0, d), dtype=s.dtype), fresh[at]
        for i in range(len(window) - 1, -1, -1):
            own = slice(edge[i], edge[i + 1])
            dh = ds[own]
            dh[:len(back)] += back
            np.multiply(of[own].reshape(-1, 3, d), dh[:, None], out=inner[own].reshape(-1, 3, d))
            back = inner[own] @ u_back
            back += dh * z[own]
            if stops[own].any():
                back *= ~stops[own][:, None]
        g["u"][:] = old.T @ inner
        inner[:, 2 * d:] = ds * of_n
        last = before[at].astype(self.class_of.dtype)
        order = np.argsort(last, kind="stable")
        last = last[order]
        first = np.flatnonzero(np.diff(last, prepend=-1))
        g["x"][last[first]] = np.add.reduceat(inner.take(order, axis=0), first, axis=0)
        return h, g


def _inputs(symbols: np.ndarray, lengths: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbol before each token, whether it is a document's first)."""
    first = (np.cumsum(lengths) - lengths)[lengths > 0]
    before = np.empty_like(symbols)
    before[1:] = symbols[:-1]
    before[first] = begin
    fresh = np.zeros(len(symbols), dtype=bool)
    fresh[first] = True
    return before, fresh
