"""Small decision trees in numpy: one tree, or a boosted sequence of them.

They are fitted on bounded tables of labelled rows (at most some tens of
thousands) and applied to many rows inside tasks; a fitted model is a few
kilobytes.
"""

from __future__ import annotations

import numpy as np


class Tree:
    """A regression tree: the split of least squared error, depth first.

    On 0/1 targets the squared error is the Gini impurity, so the same tree
    serves as a classifier whose leaves hold the share of ones."""

    def __init__(self, depth: int, min_leaf: int = 5):
        self.depth, self.min_leaf = depth, min_leaf

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, leaf=None) -> Tree:
        """``leaf(rows)`` overrides the leaf value (default: the weighted mean)."""
        w = np.ones(len(y)) if weight is None else weight
        value = leaf or (lambda rows: float(np.average(y[rows], weights=w[rows])))
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []

        def grow(rows: np.ndarray, depth: int) -> int:
            k = len(self.value)
            for part, first in ((self.feature, -1), (self.cut, 0.0), (self.left, k), (self.right, k)):
                part.append(first)
            self.value.append(value(rows))
            split = self._best(x[rows], y[rows], w[rows]) if depth else None
            if split:
                self.feature[k], self.cut[k] = split
                below = x[rows, split[0]] <= split[1]
                self.left[k] = grow(rows[below], depth - 1)
                self.right[k] = grow(rows[~below], depth - 1)
            return k

        grow(np.arange(len(y)), self.depth)
        for name in ("feature", "cut", "left", "right", "value"):
            setattr(self, name, np.array(getattr(self, name)))
        return self

    def _best(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[int, float] | None:
        best, found, n = 1e-9, None, len(y)
        total, weight = (w * y).sum(), w.sum()
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v = x[order, f]
            sums, weights = np.cumsum((w * y)[order])[:-1], np.cumsum(w[order])[:-1]
            allowed = v[1:] > v[:-1]
            allowed[: self.min_leaf - 1] = False
            allowed[n - self.min_leaf :] = False
            if not allowed.any():
                continue
            gain = sums**2 / weights + (total - sums) ** 2 / np.maximum(weight - weights, 1e-12) - total**2 / weight
            gain[~allowed] = -1
            k = int(gain.argmax())
            if gain[k] > best:
                best, found = gain[k], (f, float((v[k] + v[k + 1]) / 2))
        return found

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        for _ in range(self.depth):
            f = self.feature[at]
            go = x[np.arange(len(x)), np.maximum(f, 0)] <= self.cut[at]
            at = np.where(f < 0, at, np.where(go, self.left[at], self.right[at]))
        return self.value[at]


class BoostedTrees:
    """Gradient boosting with logistic loss and Newton leaf values."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, min_leaf: int = 5):
        self.rounds, self.depth, self.rate, self.min_leaf = rounds, depth, rate, min_leaf

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(share / (1 - share))), []
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            tree = Tree(self.depth, self.min_leaf).fit(x, g, leaf=lambda r, g=g, h=h: float(g[r].sum() / (h[r].sum() + 1.0)))
            score += self.rate * tree.predict(x)
            self.trees.append(tree)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += self.rate * tree.predict(x)
        return 1 / (1 + np.exp(-score))
