"""Histogram gradient-boosted trees for a yes-or-no label, grown level by level and flattened into arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees: inner node k of tree t sends a row right where x[feature] > cut; leaves hold log-odds."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; all rows step down a level of a tree at once."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(cut)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, least: float = 2.0) -> Trees:
    """Newton boosting of the logistic loss. Without both labels: the constant (y's mean, 0.5 for no rows)."""
    if len(y) == 0 or y.min() == y.max():
        p = 0.5 if len(y) == 0 else min(max(float(y[0]), 0.01), 0.99)
        return Trees(float(np.log(p / (1 - p))), np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 0)))
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.column_stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(width)]).astype(np.int64)
    p = y.mean()
    base = float(np.log(p / (1 - p)))
    f = np.full(n, base)
    inner, kept = (1 << depth) - 1, []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-f))
        g, h = y - q, q * (1 - q)
        feature, cut, cut_bin = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, bins, np.int64)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, m = (1 << level) - 1, 1 << level
            G = np.empty((width, m, bins))
            H = np.empty((width, m, bins))
            for j in range(width):
                k = (node - first) * bins + binned[:, j]
                G[j] = np.bincount(k, g, m * bins).reshape(m, bins)
                H[j] = np.bincount(k, h, m * bins).reshape(m, bins)
            gl, hl = G.cumsum(2), H.cumsum(2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least) | (ht - hl < least)] = 0
            for j in range(width):
                gain[j, :, len(edges[j]) :] = 0
            for k in range(m):
                j, at = np.unravel_index(np.argmax(gain[:, k]), (width, bins))
                if gain[j, k, at] > 1e-6:
                    feature[first + k], cut[first + k], cut_bin[first + k] = j, edges[j][at], at
            node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > cut_bin[node])
        k = node - inner
        leaf = rate * np.bincount(k, g, inner + 1) / (np.bincount(k, h, inner + 1) + ridge)
        f += leaf[k]
        kept.append((feature, cut, leaf))
    return Trees(base, *(np.array(x) for x in zip(*kept, strict=True)))
