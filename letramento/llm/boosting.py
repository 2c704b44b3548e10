"""Histogram gradient-boosted trees for a binary label, in numpy.

Columns are cut into at most ``bins`` quantile bins; each level of a tree takes the
best split of every open node from histograms of gradients and hessians. Trees are
complete binary trees of one depth, flattened into (tree, node) arrays; a batch is
scored by moving all rows down all trees at once.
"""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, ridge: float = 1.0,
                 least_hessian: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge, self.least = trees, depth, rate, bins, ridge, least_hessian
        inner, leaves = (1 << depth) - 1, 1 << depth
        self.feature = np.zeros((trees, inner), np.int32)
        self.threshold = np.full((trees, inner), np.inf)
        self.value = np.zeros((trees, leaves))
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        """One class or no rows: a constant score (1 with no rows at all)."""
        if len(y) == 0:
            self.base = np.inf
            return self
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        if y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], 1)
        score = np.full(len(y), self.base)
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            score += self._grow(t, binned, cuts, p - y, p * (1 - p))
        return self

    def _grow(self, t: int, binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(g), np.int64), np.arange(len(g))
        for level in range(self.depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-6)
            feature, cut = np.zeros(width, np.int32), np.full(width, -1)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                size = len(c) + 1
                at = node * size + binned[:, f]
                gs, hs = (np.bincount(at, w, width * size).reshape(width, size).cumsum(1) for w in (g, h))
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + self.ridge) + (gt - gl)**2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                gain[(hl < self.least) | (ht - hl < self.least)] = -1
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better], feature[better], cut[better] = top[better], f, k[better]
            self.feature[t, first:first + width] = feature
            self.threshold[t, first:first + width] = [cuts[f][k] if k >= 0 else np.inf for f, k in zip(feature, cut)]
            right = (cut[node] >= 0) & (binned[rows, feature[node]] > cut[node])
            node = node * 2 + right
        leaves = 1 << self.depth
        total_g, total_h = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        self.value[t] = -self.rate * total_g / (total_h + self.ridge)
        return self.value[t][node]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        if not len(x):
            return np.zeros(0)
        at, trees, rows = np.zeros((len(x), self.trees), np.int64), np.arange(self.trees), np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go = x[rows, self.feature[trees, at]] > self.threshold[trees, at]
            at = at * 2 + 1 + go
        total = self.base + self.value[trees, at - ((1 << self.depth) - 1)].sum(1)
        return 1 / (1 + np.exp(-total))
