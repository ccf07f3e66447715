"""Gradient-boosted trees on dense features, and isotonic calibration.

Small on purpose: histogram splits over at most 64 quantile bins, depth-wise
trees, logistic loss with second-order leaves. Deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    rate: float = 0.15
    rounds: int = 120
    depth: int = 4
    l2: float = 1.0
    least: float = 2.0
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Trees:
        n, d = x.shape
        w = np.ones(n) if weight is None else weight
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1])) if n else np.zeros(0) for j in range(d)]
        b = self._bin(x)
        width = max([len(e) + 1 for e in self.edges], default=1)
        p = np.clip((w @ y) / max(w.sum(), 1e-9), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        f = np.full(n, self.base)
        column = np.arange(d) * width
        for _ in range(self.rounds):
            prob = 1 / (1 + np.exp(-f))
            g, h = w * (prob - y), w * prob * (1 - prob)
            size = 2 ** (self.depth + 1) - 1
            feature, cut, leaf = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
            node = np.zeros(n, np.int64)
            for level in range(self.depth + 1):
                first = 2**level - 1
                for at in range(first, 2 * first + 1):
                    mine = np.flatnonzero(node == at)
                    if not len(mine):
                        continue
                    gs, hs = g[mine].sum(), h[mine].sum()
                    leaf[at] = -self.rate * gs / (hs + self.l2)
                    if level == self.depth or len(mine) < 4:
                        continue
                    flat = (b[mine] + column).ravel()
                    gh = np.bincount(flat, np.repeat(g[mine], d), d * width).reshape(d, width).cumsum(1)
                    hh = np.bincount(flat, np.repeat(h[mine], d), d * width).reshape(d, width).cumsum(1)
                    gr, hr = gs - gh, hs - hh
                    gain = gh**2 / (hh + self.l2) + gr**2 / (hr + self.l2) - gs**2 / (hs + self.l2)
                    gain[(hh < self.least * 0.05) | (hr < self.least * 0.05)] = -1
                    j, c = np.unravel_index(np.argmax(gain), gain.shape)
                    if gain[j, c] > 1e-6:
                        feature[at], cut[at] = j, c
                        right = b[mine, j] > c
                        node[mine] = 2 * at + 1 + right
            self.trees.append((feature, cut, leaf))
            f += leaf[node]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if not len(x):
            return out
        b = self._bin(x)
        rows = np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                j = feature[node]
                go = j >= 0
                right = b[rows, np.maximum(j, 0)] > cut[node]
                node = np.where(go, 2 * node + 1 + right, node)
            out += leaf[node]
        return out

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest margin that each row can have where NaN
        stands for any value."""
        free = np.isnan(x)
        some = free.any(0)
        b = self._bin(x)

        def walk(tree: tuple[np.ndarray, np.ndarray, np.ndarray], at: int):
            j = tree[0][at]
            if j < 0:
                return tree[2][at], tree[2][at]
            (low0, high0), (low1, high1) = walk(tree, 2 * at + 1), walk(tree, 2 * at + 2)
            right = b[:, j] > tree[1][at]
            low = np.where(right, low1, low0)
            high = low if low0 is high0 and low1 is high1 else np.where(right, high1, high0)
            if some[j]:
                low, high = np.where(free[:, j], np.minimum(low0, low1), low), np.where(free[:, j], np.maximum(high0, high1), high)
            return low, high

        least, most = np.full(len(x), self.base), np.full(len(x), self.base)
        for tree in self.trees if len(x) else ():
            low, high = walk(tree, 0)
            least += low
            most += high
        return least, most


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(scores, probabilities): the non-decreasing step fit of y by score,
    by pooling adjacent violators."""
    order = np.argsort(score, kind="stable")
    s, t = score[order], y[order].astype(float)
    w = (np.ones(len(s)) if weight is None else weight[order]).astype(float)
    value, mass, start = [], [], []
    for i in range(len(s)):
        value.append(t[i])
        mass.append(w[i])
        start.append(i)
        while len(value) > 1 and value[-2] >= value[-1]:
            m = mass[-2] + mass[-1]
            value[-2] = (value[-2] * mass[-2] + value[-1] * mass[-1]) / m
            mass[-2] = m
            value.pop(), mass.pop(), start.pop()
    return s[np.array(start, int)], np.array(value)


def calibrated(score: np.ndarray, fit: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    at, value = fit
    if not len(at):
        return np.full(len(score), 0.5)
    return value[np.clip(np.searchsorted(at, score, side="right") - 1, 0, len(value) - 1)]
