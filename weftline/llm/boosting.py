"""Gradient-boosted trees for small tables, in numpy: binned features, logistic loss."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class BoostedTrees:
    """Complete binary trees of one depth: ``feature`` and ``cut`` per inner node, ``leaf`` values."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1).astype(np.uint8)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        b = self.bins(x)
        rows = np.arange(len(x))
        out = np.full(len(x), self.start)
        depth = int(np.log2(self.leaf.shape[1]))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (b[rows, f[node]] > c[node])
            out += leaf[node - (len(leaf) - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, ridge: float = 1.0) -> BoostedTrees:
    """Boost ``trees`` trees on rows ``x`` with 0/1 targets ``y``."""
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS)[1:-1])) for col in x.T]
    edges = [np.unique(np.concatenate([e, (np.unique(col)[1:] if len(np.unique(col)) <= BINS else [])])) for e, col in zip(edges, x.T)]
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    inner = (1 << depth) - 1
    model = BoostedTrees(edges, np.zeros((trees, inner), np.int64), np.full((trees, inner), 255, np.int64),
                         np.zeros((trees, inner + 1)), float(np.log(share / (1 - share))))
    b = model.bins(x).astype(np.int64)
    n, width = b.shape
    size = 2 * BINS + 2
    margin = np.full(n, model.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            count = 1 << level
            local = node - (count - 1)
            best = np.full(count, 1e-9)
            for f in range(width):
                slot = local * size + b[:, f]
                gs = np.bincount(slot, g, count * size).reshape(count, size).cumsum(1)
                hs = np.bincount(slot, h, count * size).reshape(count, size).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (gt - gs)**2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                spot = gain.argmax(1)
                top = gain[np.arange(count), spot]
                for k in np.flatnonzero(top > best):
                    best[k] = top[k]
                    model.feature[t, count - 1 + k], model.cut[t, count - 1 + k] = f, spot[k]
            node = 2 * node + 1 + (b[np.arange(n), model.feature[t, node]] > model.cut[t, node])
        local = node - inner
        gs, hs = np.bincount(local, g, inner + 1), np.bincount(local, h, inner + 1)
        model.leaf[t] = -rate * gs / (hs + ridge)
        margin += model.leaf[t][local]
    return model
