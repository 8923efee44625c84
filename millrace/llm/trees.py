"""Gradient-boosted trees with monotonic constraints, in numpy.

Trees of one depth are grown on binned features and kept as flat node arrays:
row i of ``feature`` and ``cut`` is a whole tree in heap order, so scoring a
batch takes ``depth`` gathers for all rows and trees at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

BINS = 64
RIDGE = 1.0


def descend(feature: np.ndarray, cut: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Leaf number of every row of ``x`` in every tree, (rows, trees)."""
    trees, nodes = feature.shape
    at = np.zeros((len(x), trees), np.int64)
    tree, row = np.arange(trees)[None, :], np.arange(len(x))[:, None]
    for _ in range((nodes + 1).bit_length() - 1):
        at = 2 * at + 1 + (x[row, feature[tree, at]] > cut[tree, at])
    return at - nodes


@dataclass(frozen=True)
class Forest:
    """``feature``, ``cut``: (trees, 2**depth - 1), value above ``cut`` goes right; ``leaf``: (trees, 2**depth)."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        leaf = descend(self.feature, self.cut, x)
        margin = self.start + self.leaf[np.arange(len(self.leaf)), leaf].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def grow(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, monotone: Sequence[int], trees: int = 60, depth: int = 3,
    rate: float = 0.2,
) -> Forest:
    """Boost logistic loss. ``monotone``: per feature 1 (more never lowers the
    score), -1 (never raises it) or 0."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin, grown = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree, added = _tree(bins, weight * (p - y), weight * p * (1 - p), cuts, monotone, depth)
        margin += rate * added
        grown.append(tree)
    feature, cut, leaf = (np.stack(part) for part in zip(*grown, strict=True))
    return Forest(feature, cut, leaf * rate, start)


def _tree(bins, slope, curve, cuts, monotone, depth):
    """One tree, level by level, and its value for every row.

    A node inherits the range its value may take; a split on a constrained
    feature divides the range at the middle of its two sides, so no later split
    below can break the order.
    """
    nodes = 2**depth - 1
    feature, cut = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
    at = np.zeros(len(bins), np.int64)
    low, high = np.full(2 * nodes + 1, -np.inf), np.full(2 * nodes + 1, np.inf)
    for node in range(nodes):
        rows = np.flatnonzero(at == node)
        best = _best_split(bins[rows], slope[rows], curve[rows], monotone, low[node], high[node])
        left, right = 2 * node + 1, 2 * node + 2
        low[[left, right]], high[[left, right]] = low[node], high[node]
        if best is None:
            at[rows] = left
            continue
        _, f, b, value_left, value_right = best
        feature[node], cut[node] = f, cuts[f][b]
        at[rows] = np.where(bins[rows, f] > b, right, left)
        middle = (value_left + value_right) / 2
        if monotone[f] > 0:
            high[left], low[right] = middle, middle
        elif monotone[f] < 0:
            low[left], high[right] = middle, middle
    where = at - nodes
    g, h = np.bincount(where, slope, nodes + 1), np.bincount(where, curve, nodes + 1)
    leaf = np.clip(-g / (h + RIDGE), low[nodes:], high[nodes:])
    return (feature, cut, leaf), leaf[where]


def _best_split(bins, slope, curve, monotone, low, high):
    total_g, total_h = slope.sum(), curve.sum()
    own = total_g**2 / (total_h + RIDGE)
    best = None
    for f in range(bins.shape[1]):
        top = int(bins[:, f].max(initial=0))
        if not top:
            continue
        g = np.cumsum(np.bincount(bins[:, f], slope, top + 1))[:-1]
        h = np.cumsum(np.bincount(bins[:, f], curve, top + 1))[:-1]
        left, right = np.clip(-g / (h + RIDGE), low, high), np.clip(-(total_g - g) / (total_h - h + RIDGE), low, high)
        gain = -(2 * g * left + (h + RIDGE) * left**2) - (
            2 * (total_g - g) * right + (total_h - h + RIDGE) * right**2
        ) - own
        usable = (h > 1.0) & (total_h - h > 1.0) & (monotone[f] * (right - left) >= 0)
        if usable.any():
            b = int(np.argmax(np.where(usable, gain, -np.inf)))
            if gain[b] > 1e-6 and (best is None or gain[b] > best[0]):
                best = (gain[b], f, b, left[b], right[b])
    return best
