"""Gradient-boosted trees for two classes, on few features of few distinct values."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of fixed depth on binned features, fitted to the gradient of the logistic loss."""

    def __init__(self, trees: int = 50, depth: int = 4, rate: float = 0.3, bins: int = 24, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        x = x.astype(np.float32)
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.start)
        nodes = 2**self.depth - 1
        self.feature = np.zeros((self.trees, nodes), np.int64)
        self.threshold = np.full((self.trees, nodes), np.inf, np.float32)
        self.leaf = np.zeros((self.trees, nodes + 1), np.float32)
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            gradient, weight = y - p, p * (1 - p)
            at = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first, width = 2**level - 1, 2**level
                best_gain = np.full(width, 1e-6)
                for f, edges in enumerate(self.edges):
                    if not len(edges):
                        continue
                    size = len(edges) + 1
                    slot = (at - first) * size + binned[:, f]
                    g = np.bincount(slot, gradient, width * size).reshape(width, size).cumsum(axis=1)
                    h = np.bincount(slot, weight, width * size).reshape(width, size).cumsum(axis=1)
                    gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                    gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                    cut = gain.argmax(axis=1)
                    top = gain[np.arange(width), cut]
                    better = top > best_gain
                    best_gain[better] = top[better]
                    self.feature[t, first : first + width][better] = f
                    self.threshold[t, first : first + width][better] = edges[cut[better]]
                at = 2 * at + 1 + (x[np.arange(len(x)), self.feature[t, at]] > self.threshold[t, at])
            leaf = at - nodes
            g, h = np.bincount(leaf, gradient, nodes + 1), np.bincount(leaf, weight, nodes + 1)
            self.leaf[t] = self.rate * g / (h + self.ridge)
            score += self.leaf[t][leaf]
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float32)
        score = np.full(len(x), self.start)
        rows = np.arange(len(x))
        nodes = 2**self.depth - 1
        for t in range(self.trees):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, self.feature[t, at]] > self.threshold[t, at])
            score += self.leaf[t][at - nodes]
        return 1 / (1 + np.exp(-score))
