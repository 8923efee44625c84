"""Sparse matrices in compressed rows, and their row-by-row product."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Entries that a product forms at a time.
SLAB = 1 << 20


@dataclass(frozen=True)
class Csr:
    """Row ``i`` holds ``values[starts[i]:starts[i + 1]]`` in ``columns`` of the same places."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def runs(cls, ends: np.ndarray) -> Csr:
        """Row ``i`` has ones from where the row before ended to ``ends[i]``."""
        width = int(ends[-1]) if len(ends) else 0
        starts = np.concatenate((np.zeros(1, np.int64), ends))
        return cls(starts, np.arange(width), np.ones(width, np.int64), width)

    @classmethod
    def members(cls, group: np.ndarray, groups: int) -> Csr:
        """Row ``i`` has a one in column ``group[i]``."""
        return cls(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), groups)

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        counts = np.bincount(self.columns, minlength=self.width)
        starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
        return Csr(starts, self.row_of_entry()[order], self.values[order], len(self.starts) - 1)


def product(left: Csr, right: Csr, slab: int = SLAB) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, column, value)`` of the entries of ``left @ right``, some rows at a time.

    Gustavson: a row of the product is the sum of the rows of ``right`` that
    the entries of the row of ``left`` name. A slab takes whole rows of
    ``left`` while at most ``slab`` entries are to be summed, one at least.
    """
    lengths = np.diff(right.starts)[left.columns]
    work = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths)))[left.starts]
    rows, at, last = left.row_of_entry(), 0, len(left.starts) - 1
    while at < last:
        to = max(at + 1, int(np.searchsorted(work, work[at] + slab, "right")) - 1)
        entries = slice(int(left.starts[at]), int(left.starts[to]))
        counts = lengths[entries]
        begin = np.repeat(right.starts[left.columns[entries]] - (np.cumsum(counts) - counts), counts)
        place = begin + np.arange(len(begin))
        row, column = np.repeat(rows[entries], counts), right.columns[place]
        value = np.repeat(left.values[entries], counts) * right.values[place]
        at = to
        if not len(row):
            continue
        key = row * right.width + column
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, row, column, value = key[order], row[order], column[order], value[order]
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        yield row[heads], column[heads], np.add.reduceat(value, heads)
