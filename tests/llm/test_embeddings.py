"""Embedding near copies against all pairs; recall at just the least cosine."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from millrace.llm import collisions
from millrace.llm.embedding_dedup import near_duplicates

SCHEMA = "vec_id long, embedding array<double>, label int, _node string, n_links string"


def frame(workers, rows):
    return workers.createDataFrame([(i, v, k, "mine", "x") for i, v, k in rows], SCHEMA)


def usable(vector, label):
    return label is not None and vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def brute(rows, cosine=0.93):
    n, links = len(rows), [[] for _ in rows]
    for a in range(n):
        for b in range(n):
            (_, x, k), (_, y, m) = rows[a], rows[b]
            if a != b and usable(x, k) and usable(y, m) and k == m and len(x) == len(y):
                x, y = (np.array(v) / max(map(abs, v)) for v in (x, y))
                if x @ y >= cosine * math.sqrt(x @ x) * math.sqrt(y @ y):
                    links[a].append(b)
    out = Counter()
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        least = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        out[(rows[a][0], len(links[a]), least, rows[a][0] == least)] += 1
    return out


def result(df):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def near(rng, centre, cosine):
    other = rng.standard_normal(len(centre))
    other -= (other @ centre) * centre
    other /= np.linalg.norm(other)
    return cosine * centre + math.sqrt(1 - cosine**2) * other


@pytest.mark.parametrize("tile", [1024, 7])
def test_groups_copies_and_odd_vectors(workers, tile):
    rng = np.random.default_rng(3)
    rows = []
    for group in range(12):
        centre = rng.standard_normal(32)
        centre /= np.linalg.norm(centre)
        for _ in range(1 + 6 * group % 31):
            rows.append((len(rows), (near(rng, centre, 0.985) * rng.choice([1e-200, 1, 1e200])).tolist(), group % 3))
    rows += [(i + 1000, v, k) for i, v, k in rows[::4]] + [(i, v, None) for i, v, k in rows[::9]]
    rows += [(5000, None, 1), (5001, [], 1), (5002, [0.0] * 32, 1), (5003, [math.nan] + [1.0] * 31, 1), (5004, [None] + [1.0] * 31, 1)]
    rows += [(5005, [math.inf] + [1.0] * 31, 1), (5006, [1.0], 1), (5007, [2.0], 1), (5008, [-2.0], 1), (5009, [1.0, 0.0], 1)]
    rows += [(None, rows[3][1], rows[3][2]), (None, [9.0] * 5, 2), (5010, rows[40][1], rows[40][2]), (5010, rows[40][1], rows[40][2])]
    assert result(near_duplicates(frame(workers, rows), tile=tile)) == brute(rows)


def test_empty_table(workers):
    assert near_duplicates(frame(workers, [])).count() == 0


def test_recall_at_the_least_cosine(workers):
    """4,000 pairs of cosine 0.93 to 0.935 among 8,000 vectors of two labels."""
    rng = np.random.default_rng(8)
    rows = []
    for n in range(4000):
        centre = rng.standard_normal(64)
        centre /= np.linalg.norm(centre)
        for v in (centre, near(rng, centre, 0.93 + 1e-9 + 0.005 * rng.random())):
            rows.append((len(rows), v.tolist(), n % 2))
    got = {r.vec_id: r for r in near_duplicates(frame(workers, rows)).collect()}
    caught = sum(got[n + 1].component_id <= n and got[n].n_links >= 1 for n in range(0, 8000, 2))
    assert caught >= 0.985 * 4000
    unit = np.array([v for _, v, _ in rows])
    wrong = 0
    for k in (0, 1):
        at = [n for n, (_, _, label) in enumerate(rows) if label == k]
        wrong += ((unit[at] @ unit[at].T >= 0.93).sum() - len(at)) // 2
    assert sum(r.n_links for r in got.values()) // 2 <= wrong + 1


def test_depth_keeps_recall():
    rule = collisions.calibrated(64, 0.93)
    for depth in (1, 2, 3):
        assert (1 - rule.agree**depth) ** rule.deals(depth) <= collisions.MISSED
    assert collisions.depth_for(10) == 1 and collisions.depth_for(10**6) == 2 and collisions.depth_for(10**9) == 4
    rng = np.random.default_rng(5)
    left = rng.standard_normal((3000, 64))
    left /= np.linalg.norm(left, axis=1)[:, None]
    right = np.array([near(rng, v, 0.93) for v in left])
    deals = rule.deals(2)
    met = (collisions.cells(left, 2, deals) == collisions.cells(right, 2, deals)).any(axis=1)
    assert met.mean() >= 0.99
