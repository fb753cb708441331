"""Gradient-boosted trees for a yes-or-no label, on a bounded sample of rows.

Trees of a fixed depth on binned features with the logistic loss; a tree is two arrays
(feature and bin of every inner node) and the leaf values, so that scoring is a few
array look-ups for a whole batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    edges: list[np.ndarray]  # by feature: upper edges of its bins but the last
    features: np.ndarray  # (trees, inner nodes)
    bins: np.ndarray
    leaves: np.ndarray  # (trees, leaves)
    start: float

    def binned(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, rows[:, k], side="left") for k, e in enumerate(self.edges)], 1)

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        binned = self.binned(rows)
        total = np.full(len(rows), self.start)
        at_row = np.arange(len(rows))
        depth = self.leaves.shape[1].bit_length() - 1
        for feature, cut, leaf in zip(self.features, self.bins, self.leaves, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (binned[at_row, feature[node]] > cut[node])
            total += leaf[node - len(leaf) + 1]
        return total


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
        bins: int = 32, least: float = 5.0) -> Boosted:
    """``least`` smooths leaves and forbids cuts that leave less weight on a side."""
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    edges = [np.unique(np.quantile(rows[:, k], quantiles)) for k in range(rows.shape[1])]
    mean = np.clip(labels.mean(), 0.01, 0.99)
    model = Boosted(edges, np.zeros((trees, 2**depth - 1), np.int64), np.zeros((trees, 2**depth - 1), np.int64),
                    np.zeros((trees, 2**depth)), float(np.log(mean / (1 - mean))))
    binned = model.binned(rows)
    width, n_features = bins, rows.shape[1]
    flat = binned + np.arange(n_features) * width
    score = np.full(len(rows), model.start)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = labels - p, p * (1 - p)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first = 2**level - 1
            n = 2**level
            cell = ((node - first)[:, None] * n_features * width + flat).ravel()
            shape = (n, n_features, width)
            g = np.bincount(cell, np.repeat(gradient, n_features), n * n_features * width).reshape(shape)
            h = np.bincount(cell, np.repeat(weight, n_features), n * n_features * width).reshape(shape)
            left_g, left_h = g.cumsum(2), h.cumsum(2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            gain = (left_g**2 / (left_h + least) + (all_g - left_g)**2 / (all_h - left_h + least)
                    - all_g**2 / (all_h + least))
            best = gain.reshape(n, -1).argmax(1)
            model.features[tree, first:first + n], model.bins[tree, first:first + n] = np.divmod(best, width)
            feature, cut = model.features[tree, node], model.bins[tree, node]
            node = 2 * node + 1 + (binned[np.arange(len(rows)), feature] > cut)
        leaf = node - 2**depth + 1
        sums = np.bincount(leaf, gradient, 2**depth)
        weights = np.bincount(leaf, weight, 2**depth)
        model.leaves[tree] = rate * sums / (weights + least / 5)
        score += model.leaves[tree, leaf]
    return model
