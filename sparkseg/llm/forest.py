"""Bagged decision trees on small samples, in numpy."""

from __future__ import annotations

import numpy as np


class Tree:
    """A binary classification tree: arrays of split feature, threshold, children and rate of ones."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = 6, least: int = 5):
        self.feature, self.threshold, self.left, self.right, self.rate = [], [], [], [], []
        self._grow(x, y, rng, depth, least)
        self.feature, self.left, self.right = (np.array(v, dtype=int) for v in (self.feature, self.left, self.right))
        self.threshold, self.rate = np.array(self.threshold), np.array(self.rate)

    def _grow(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, least: int) -> int:
        node = len(self.rate)
        for values, value in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.rate, (y.sum() + 0.5) / (len(y) + 1))):
            values.append(value)
        if depth and len(y) >= 2 * least and 0 < y.sum() < len(y):
            best = self._split(x, y, rng, least)
            if best:
                feature, threshold = best
                low = x[:, feature] <= threshold
                self.feature[node], self.threshold[node] = feature, threshold
                self.left[node] = self._grow(x[low], y[low], rng, depth - 1, least)
                self.right[node] = self._grow(x[~low], y[~low], rng, depth - 1, least)
        return node

    @staticmethod
    def _split(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, least: int) -> tuple[int, float] | None:
        """The split of least Gini impurity among a random half of the features."""
        n, best, found = len(y), np.inf, None
        for f in rng.permutation(x.shape[1])[: (x.shape[1] + 1) // 2]:
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            k = np.arange(1, n)
            ok = (v[:-1] < v[1:]) & (k >= least) & (n - k >= least)
            if not ok.any():
                continue
            a, b = ones[:-1], ones[-1] - ones[:-1]
            cost = np.where(ok, a * (k - a) / k + b * (n - k - b) / (n - k), np.inf)
            i = int(np.argmin(cost))
            if cost[i] < best:
                best, found = cost[i], (int(f), float((v[i] + v[i + 1]) / 2))
        return found

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=int)
        while True:
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                return self.rate[at]
            node = at[inner]
            low = x[inner, self.feature[node]] <= self.threshold[node]
            at[inner] = np.where(low, self.left[node], self.right[node])


class Forest:
    """The mean of trees grown on bootstrap samples; the same for the same data and seed."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 25, depth: int = 6, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(trees):
            drawn = rng.integers(0, len(y), len(y))
            self.trees.append(Tree(x[drawn], y[drawn], rng, depth))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.mean([t.predict(x) for t in self.trees], axis=0)
