"""An R-tree over count vectors, searched by an upper bound of overlap."""

from __future__ import annotations

import numpy as np

LEAF = 16


def reachable(least: np.ndarray, sizes: np.ndarray, other: int, percent: int) -> np.ndarray:
    """Whether sets of these sizes could link with one of size ``other`` when
    they share at most ``least`` elements."""
    return 100 * least >= percent * (sizes + other - least)


class CountTree:
    """Points are how many elements of a set fall in each hash group.

    Two sets share at most the sum over the groups of the smaller count. The
    tree is packed bottom up from points sorted by size and leading counts. A
    node keeps the greatest count per group below it and the least size, so the
    same sum bounds what a query can share with anything below.
    """

    def __init__(self, counts: np.ndarray) -> None:
        sizes = counts.sum(axis=1)
        slab = max(LEAF, int(np.sqrt(len(counts) / LEAF)) * LEAF)
        by_size = np.argsort(sizes, kind="stable")
        run = np.arange(len(counts)) // slab
        by_size = by_size[np.lexsort((counts[by_size, 0], run))]
        self.order, self.counts, self.sizes = by_size, counts[by_size], sizes[by_size]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        upper, least = self.counts, self.sizes
        while len(upper) > LEAF:
            starts = np.arange(0, len(upper), LEAF)
            upper, least = np.maximum.reduceat(upper, starts), np.minimum.reduceat(least, starts)
            self.levels.append((upper, least))

    def search(self, point: np.ndarray, percent: int) -> np.ndarray:
        """Indexes of the points that the bound cannot exclude."""
        size, at = int(point.sum()), None
        for upper, least in [*reversed(self.levels), (self.counts, self.sizes)]:
            if at is None:
                at = np.arange(len(upper))
            else:
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < len(upper)]
            shared = np.minimum(upper[at], point).sum(axis=1)
            at = at[reachable(shared, least[at], size, percent)]
        return self.order[at]
