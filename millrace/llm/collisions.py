"""Near neighbours by counting collisions in sorted one-dimensional projections.

A vector is projected on many random directions. In each of them the vectors
are sorted, and those within a window around a query's value collide with it.
Two vectors at the least cosine collide in a share of the directions that is
measured on pairs made to have just that cosine; the count that all but a
``MISSED`` share of them reach is the count a pair needs to be verified.

To compare vectors without meeting all others of a label, they are dealt to
cells first, by the directions in which they stand out: in each of several
deals a cell is named by the strongest direction out of each of ``depth``
bundles. The depth follows from the label's size, so that cells stay small,
and the number of deals from the share of made pairs that part in one deal.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np

DIRECTIONS = 24
BUNDLE = 16
#: Share of pairs at the least cosine that the deals may part, and that the count may pass over.
MISSED = 0.002
#: Unrelated vectors that a cell holds, at most about.
CELL = 1024
_TRIALS = 20_000


@dataclass(frozen=True)
class Calibration:
    """What holds for vectors of one length and one least cosine."""

    cosine: float
    window: float
    needed: int
    #: Share of pairs at the least cosine that agree in the strongest direction of a bundle.
    agree: float

    def deals(self, depth: int) -> int:
        return math.ceil(math.log(MISSED) / math.log(1 - min(self.agree**depth, 1 - 1e-9)))


def _directions(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def depth_for(vectors: int) -> int:
    """Bundles that name a cell, so that ``vectors`` unrelated ones spread over cells of ``CELL``."""
    depth = 1
    while vectors > CELL * (2 * BUNDLE) ** depth:
        depth += 1
    return depth


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled by powers of two first so that no square over- or underflows."""
    scale = np.frexp(np.abs(vectors).max(axis=1))[1]
    vectors = np.ldexp(vectors, -scale[:, None])
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


@functools.lru_cache(maxsize=64)
def calibrated(dim: int, cosine: float) -> Calibration:
    """Measured on ``_TRIALS`` random pairs of just that cosine; the window is their usual distance."""
    rng = np.random.default_rng([7, dim])
    window = math.sqrt(max(2 - 2 * cosine, 1e-6))
    if dim < 2:
        return Calibration(cosine, window, 1, 1.0)
    collided, agreed = [], 0
    for _ in range(_TRIALS // 1000):
        a = rng.standard_normal((1000, dim))
        a /= np.linalg.norm(a, axis=1)[:, None]
        b = rng.standard_normal((1000, dim))
        b -= (a * b).sum(1)[:, None] * a
        b *= (math.sqrt(max(0.0, 1 - cosine * cosine)) / np.linalg.norm(b, axis=1))[:, None]
        b += cosine * a
        fresh = rng.standard_normal((dim, DIRECTIONS))
        collided.append((np.abs(a @ fresh - b @ fresh) <= window).sum(1))
        bundle = rng.standard_normal((dim, BUNDLE))
        agreed += int((_strongest(a @ bundle) == _strongest(b @ bundle)).sum())
    counts = np.sort(np.concatenate(collided))
    return Calibration(cosine, window, int(counts[int(MISSED * len(counts))]), agreed / len(counts))


def _strongest(values: np.ndarray) -> np.ndarray:
    """Direction of the greatest value by magnitude, and its sign."""
    best = np.abs(values).argmax(axis=1)
    return 2 * best + (values[np.arange(len(values)), best] < 0)


def cells(unit: np.ndarray, depth: int, deals: int) -> np.ndarray:
    """Cell of each vector in each deal."""
    out = np.zeros((len(unit), deals), np.int64)
    for deal in range(deals):
        for level in range(depth):
            bundle = _directions(unit.shape[1], BUNDLE, 1 + deal * 64 + level)
            out[:, deal] = out[:, deal] * 2 * BUNDLE + _strongest(unit @ bundle)
    return out


def candidates(unit: np.ndarray, queries: int, others: int, calibration: Calibration, block: int = 256):
    """Pairs ``(query, other)`` that collide often enough, some queries at a time.

    The queries are the first ``queries`` rows, compared with the rows from
    ``others`` on that come after them.
    """
    n = len(unit)
    values = unit @ _directions(unit.shape[1], DIRECTIONS, 0)
    orders = np.argsort(values, axis=0, kind="stable")
    for at in range(0, queries, block):
        count = min(block, queries - at)
        hits = np.zeros(count * n, np.int32)
        rows = np.arange(count) * n
        for d in range(DIRECTIONS):
            order = orders[:, d]
            ordered = values[order, d]
            mine = values[at : at + count, d]
            low = np.searchsorted(ordered, mine - calibration.window, "left")
            size = np.searchsorted(ordered, mine + calibration.window, "right") - low
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum())) + np.repeat(low - first, size)
            hits += np.bincount(np.repeat(rows, size) + order[place], minlength=count * n).astype(np.int32)
        query, other = np.divmod(np.flatnonzero(hits >= calibration.needed), n)
        query += at
        keep = (other > query) & (other >= others)
        yield query[keep], other[keep]
