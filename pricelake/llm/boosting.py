"""Gradient-boosted trees for two classes, in numpy.

Features are binned by quantiles of the (bounded) training sample; each tree
is grown level by level to a fixed depth on the logistic loss' gradient and
curvature, from histograms.  A fitted model is a few small arrays.
"""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.3, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.ridge = trees, depth, rate, ridge
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins = self._bin(x)
        n, width = bins.shape
        mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base = float(np.log(mean / (1 - mean)))
        score = np.full(n, self.base)
        inner = 2**self.depth - 1
        self.feature = np.zeros((self.trees, inner), dtype=np.int64)
        self.cut = np.full((self.trees, inner), BINS, dtype=np.int64)  # BINS: all go left
        self.leaf = np.zeros((self.trees, 2**self.depth))
        offsets = np.arange(width) * BINS
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p) + 1e-9
            at = np.zeros(n, dtype=np.int64)  # place of each row in its level
            for level in range(self.depth):
                nodes = 2**level
                cell = (at[:, None] * (width * BINS) + offsets[None, :] + bins).ravel()
                size = nodes * width * BINS
                left_g = np.bincount(cell, np.repeat(g, width), size).reshape(nodes, width, BINS).cumsum(2)
                left_h = np.bincount(cell, np.repeat(h, width), size).reshape(nodes, width, BINS).cumsum(2)
                all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
                gain = (left_g**2 / (left_h + self.ridge) + (all_g - left_g)**2 / (all_h - left_h + self.ridge)
                        - all_g**2 / (all_h + self.ridge)).reshape(nodes, -1)
                best = gain.argmax(axis=1)
                good = gain[np.arange(nodes), best] > 1e-6
                first = nodes - 1
                self.feature[t, first:first + nodes] = best // BINS
                self.cut[t, first:first + nodes] = np.where(good, best % BINS, BINS)
                f, c = self.feature[t, first + at], self.cut[t, first + at]
                at = 2 * at + (bins[np.arange(n), f] > c)
            sum_g = np.bincount(at, g, 2**self.depth)
            sum_h = np.bincount(at, h, 2**self.depth)
            self.leaf[t] = -self.rate * sum_g / (sum_h + self.ridge)
            score += self.leaf[t, at]
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        bins, rows = self._bin(x), np.arange(len(x))
        score = np.full(len(x), self.base)
        for t in range(self.trees):
            at = np.zeros(len(x), dtype=np.int64)
            for level in range(self.depth):
                first = 2**level - 1
                f, c = self.feature[t, first + at], self.cut[t, first + at]
                at = 2 * at + (bins[rows, f] > c)
            score += self.leaf[t, at]
        return score
