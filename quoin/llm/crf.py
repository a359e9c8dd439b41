"""A linear-chain conditional random field with two labels, over the lines of documents."""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log1p

import numpy as np
import pyarrow as pa

from . import textkernel as tk
from .textkernel import U

#: Fixed value: the bytes counted as symbols.
SYMBOLS = b"#*$%&|<>~^=+@_\\/{}[]"
_BLANK, _LOWER, _UPPER, _DIGIT, _SYMBOL, _BANG, _BAR, _STOP, _OTHER, _WIDE = range(10)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[128:] = _WIDE
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[list(SYMBOLS)] = _SYMBOL
_CLASS[ord("!")] = _BANG
_CLASS[ord("|")] = _BAR
_CLASS[list(b".,;:?'\"-()")] = _STOP
_CLASS[[9, 10, 11, 12, 13, 32]] = _BLANK

#: Features of a line itself; each line also has those of the lines before and after it.
OWN = 17
WIDTH = 3 * OWN + 1
#: Lines of a text after which sums are made one by one, as few texts have so many.
LONG = 512


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, weights, first): features of every line, its length + 1, and the number of each text's first line."""
    data, offsets = tk.buffer(texts)
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    # the k-th text's first line follows all earlier texts' first lines and all line breaks before it
    first = np.searchsorted(breaks, offsets[:-1]) + np.arange(n)
    first = np.append(first, len(starts))
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    after_break = np.zeros(len(starts), dtype=bool)
    if len(starts):
        inner = np.ones(len(starts) + 1, dtype=bool)
        inner[first] = False
        after_break = inner[1:]  # the next line is of the same text, so a line break stands at the end
    size = ends - starts - after_break
    line = np.repeat(np.arange(len(starts)), ends - starts)
    kind = _CLASS.take(data)
    high = np.flatnonzero((data[1:] >= 0x80) & (data[1:] < 0x9F) & (data[:-1] == 0xC3)) + 1 if len(data) else np.zeros(0, np.int64)
    kind[high] = _UPPER  # two-byte capital letters of Latin-1
    count = np.bincount(line * 10 + kind, minlength=10 * len(starts)).reshape(-1, 10).astype(np.float64)
    w = tk.words(texts)
    of = np.searchsorted(starts, w.starts, side="right") - 1
    words = np.bincount(of, minlength=len(starts)).astype(np.float64)
    per = lambda mask: np.bincount(of[mask], minlength=len(starts)) / np.maximum(words, 1)
    same = np.concatenate(([False], (w.hashes[1:] == w.hashes[:-1]) & (of[1:] == of[:-1]))) if len(of) else np.zeros(0, bool)
    tail, before = kind[w.ends - 1] if len(of) else of, kind[np.maximum(w.ends - 2, 0)] if len(of) else of
    marked = lambda k: (k != _LOWER) & (k != _UPPER) & (k != _WIDE) & (k != _DIGIT)
    own = tk.mix(w.hashes + tk.mix(of.astype(U), 5), 6)
    seen, times = tk.tally(own)
    letters = count[:, _LOWER] + count[:, _UPPER] + count[:, _WIDE]
    solid = np.maximum(size - (count[:, _BLANK] - after_break), 1)
    x = np.zeros((len(starts), OWN))
    x[:, 0] = 1
    x[:, 1] = size == 0
    x[:, 2] = np.log1p(size) / 5
    x[:, 3] = np.log1p(words) / 3
    x[:, 4] = np.minimum(solid / np.maximum(words, 1), 30) / 5
    x[:, 5] = count[:, _UPPER] / np.maximum(letters, 1)
    x[:, 6] = count[:, _DIGIT] / solid
    x[:, 7] = count[:, _SYMBOL] / solid * 4
    x[:, 8] = count[:, _BANG] / solid * 4
    x[:, 9] = count[:, _BAR] / np.maximum(words, 1) * 2
    x[:, 10] = count[:, _STOP] / np.maximum(words, 1) * 2
    x[:, 11] = per(same)
    x[:, 12] = per(marked(tail) & marked(before)) if len(of) else 0
    x[:, 13] = per(tk.lookup(seen[times > 1], np.ones(int((times > 1).sum()), np.uint8), own) > 0) if len(of) else 0
    x[:, 14] = per((w.ends - w.starts) == 1) if len(of) else 0
    x[:, 15] = count[:, _OTHER] / solid * 4
    x[:, 16] = per((w.ends - w.starts) > 20) if len(of) else 0
    wide = np.zeros((len(starts), WIDTH))
    wide[:, :OWN] = x
    follows = np.ones(len(starts), dtype=bool)
    follows[first[:-1]] = False
    wide[1:, OWN : 2 * OWN] = x[:-1] * follows[1:, None]
    wide[:-1, 2 * OWN : 3 * OWN] = x[1:] * follows[1:, None]
    wide[:, -1] = (~follows).astype(float)
    return wide, (size + 1).astype(np.float64), first


@dataclass
class Field:
    """P(labels) is proportional to exp(sum of x @ w where a line is bad + step[label, next label])."""

    w: np.ndarray
    step: np.ndarray  # 2 x 2

    def marginals(self, x: np.ndarray, first: np.ndarray, expect: bool = True) -> tuple[np.ndarray, np.ndarray, float]:
        """P(bad) of each line, expected steps (2 x 2) over all chains if asked for, and the log normaliser of all chains.

        Forward and backward sums run over the first LONG lines of all chains at once, one line after
        the other; chains are taken in order of length, so a step costs as much as there are chains
        that long. Further lines are few and summed chain by chain.
        """
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        head, falling = first[:-1][order], -size[order]
        score = np.zeros((len(x), 2))
        score[:, 1] = x @ self.w
        longest = min(LONG, int(size.max()) if len(size) else 0)
        forward, backward = score.copy(), np.zeros((len(x), 2))
        alive = [head[: np.searchsorted(falling, -t, side="left")] + t for t in range(longest)]
        for t in range(1, longest):
            here = alive[t]
            before = forward[here - 1]
            forward[here] += np.logaddexp(before[:, :1] + self.step[0], before[:, 1:] + self.step[1])
        far = [(int(first[c]) + LONG, int(first[c + 1])) for c in np.flatnonzero(size > LONG)]
        for low, high in far:
            self._forward(score, forward, low, high)
        expected = np.zeros((2, 2))
        ends = first[1:][size > 0] - 1
        z = np.zeros(len(x))
        whole = np.logaddexp(forward[ends, 0], forward[ends, 1])
        z[ends] = whole
        for low, high in far:
            z[low - 1 : high] = z[high - 1]
            self._backward(score, backward, low, high)
            if expect:
                expected += self._steps(score, forward, backward, z, np.arange(low, high))
        for t in range(longest - 1, 0, -1):
            here = alive[t]
            z[here - 1] = z[here]
            after = score[here] + backward[here]
            backward[here - 1, 0] = np.logaddexp(self.step[0, 0] + after[:, 0], self.step[0, 1] + after[:, 1])
            backward[here - 1, 1] = np.logaddexp(self.step[1, 0] + after[:, 0], self.step[1, 1] + after[:, 1])
            if expect:
                expected += self._steps(score, forward, backward, z, here)
        return np.exp(forward[:, 1] + backward[:, 1] - z), expected, float(whole.sum())

    def _steps(self, score: np.ndarray, forward: np.ndarray, backward: np.ndarray, z: np.ndarray, here: np.ndarray) -> np.ndarray:
        """Expected steps into the given lines."""
        after = score[here] + backward[here]
        return np.array([[np.exp(forward[here - 1, a] + self.step[a, b] + after[:, b] - z[here]).sum() for b in (0, 1)] for a in (0, 1)])

    def _forward(self, score: np.ndarray, forward: np.ndarray, low: int, high: int) -> None:
        (s00, s01), (s10, s11) = self.step.tolist()
        p, q = forward[low - 1].tolist()
        rows = []
        for bad in score[low:high, 1].tolist():
            p, q = _sum(p + s00, q + s10), _sum(p + s01, q + s11) + bad
            rows.append((p, q))
        forward[low:high] = rows

    def _backward(self, score: np.ndarray, backward: np.ndarray, low: int, high: int) -> None:
        """Backward sums of the lines from low - 1 to high - 2."""
        (s00, s01), (s10, s11) = self.step.tolist()
        p = q = 0.0
        rows = []
        for bad in score[low:high, 1][::-1].tolist():
            p, q = _sum(s00 + p, s01 + bad + q), _sum(s10 + p, s11 + bad + q)
            rows.append((p, q))
        backward[low - 1 : high - 1] = rows[::-1]


def _sum(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    return max(a, b) + log1p(exp(-abs(a - b)))


def train(x: np.ndarray, first: np.ndarray, bad: np.ndarray, weight: np.ndarray, start: Field | None = None, rounds: int = 60, decay: float = 1e-3) -> Field:
    """The field that makes the given labels likely: Adam on the exact gradient of the penalised likelihood.

    weight is of a document; documents of equal weight are passed through the chains together.
    """
    groups = [(c, np.flatnonzero(weight == c)) for c in np.unique(weight)]
    parts = []
    for c, which in groups:
        rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in which])
        edge = np.concatenate(([0], np.cumsum(np.diff(first)[which])))
        y = bad[rows]
        inner = np.ones(len(rows), dtype=bool)
        inner[edge[:-1]] = False
        pairs = np.bincount((2 * y[:-1] + y[1:])[inner[1:]].astype(int), minlength=4).reshape(2, 2)
        parts.append((c, x[rows], edge, y, pairs))
    total = sum(c * len(p[1]) for (c, _), p in zip(groups, parts))
    f = start or Field(np.zeros(x.shape[1]), np.zeros((2, 2)))
    at = np.concatenate((f.w, f.step.ravel()))
    m = v = np.zeros_like(at)
    for k in range(1, rounds + 1):
        g = decay * at
        now = Field(at[:-4], at[-4:].reshape(2, 2))
        for c, rows, edge, y, pairs in parts:
            p, expected, _ = now.marginals(rows, edge)
            g[:-4] += c * (rows.T @ (p - y)) / total
            g[-4:] += c * (expected - pairs).ravel() / total
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        at = at - 0.25 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Field(at[:-4], at[-4:].reshape(2, 2))
