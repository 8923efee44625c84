"""A random forest of classification trees in numpy, kept as flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from millrace.llm.trees import descend


@dataclass(frozen=True)
class RandomForest:
    """Heap-ordered trees; ``leaf`` holds the share of label 1 in each leaf."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Mean share of label 1 over the trees, for each row of ``x``."""
        leaf = descend(self.feature, self.cut, x)
        return self.leaf[np.arange(len(self.leaf)), leaf].mean(axis=1)


def grow(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 6, seed: int = 5) -> RandomForest:
    """Each tree sees a bootstrap sample with both labels weighing alike, and
    each split a random choice of features."""
    rng = np.random.default_rng(seed)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    parts = []
    for _ in range(trees):
        drawn = rng.choice(len(y), len(y), p=weight / weight.sum())
        parts.append(_tree(x[drawn], y[drawn], depth, max(1, int(x.shape[1] ** 0.5)), rng))
    return RandomForest(*(np.stack(p) for p in zip(*parts, strict=True)))


def _tree(x: np.ndarray, y: np.ndarray, depth: int, tries: int, rng: np.random.Generator):
    nodes = 2**depth - 1
    feature, cut = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
    share = np.full(2 * nodes + 1, y.mean() if len(y) else 0.0)
    at = np.zeros(len(y), np.int64)
    for node in range(nodes):
        rows = np.flatnonzero(at == node)
        left, right = 2 * node + 1, 2 * node + 2
        share[[left, right]] = share[node]
        at[rows] = left
        if len(rows) < 4 or y[rows].min() == y[rows].max():
            continue
        found = max((_split(x[rows, f], y[rows]) + (f,) for f in rng.permutation(x.shape[1])[: 2 * tries]), key=lambda s: s[0])
        if found[0] <= 0:
            continue
        feature[node], cut[node] = found[2], found[1]
        up = x[rows, found[2]] > found[1]
        at[rows[up]] = right
        share[left], share[right] = y[rows[~up]].mean(), y[rows[up]].mean()
    return feature, cut, share[nodes:]


def _split(values: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Greatest fall of the Gini impurity along one feature, and where it lies."""
    order = np.argsort(values, kind="stable")
    v, ones = values[order], np.cumsum(y[order])
    n = np.arange(1, len(v) + 1)
    ends = np.flatnonzero(v[:-1] < v[1:])
    if not len(ends):
        return 0.0, 0.0
    total, count = ones[-1], len(v)
    a, b = ones[ends], n[ends]
    within = a * (b - a) / b + (total - a) * (count - b - total + a) / (count - b)
    best = int(np.argmin(within))
    fall = total * (count - total) / count - within[best]
    return float(fall), float((v[ends[best]] + v[ends[best] + 1]) / 2)
