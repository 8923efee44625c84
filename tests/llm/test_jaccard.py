"""The Jaccard join against all pairs, on texts made to sit around the threshold."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import jaccard
from millrace.llm.count_tree import CountTree, reachable
from millrace.llm.graph import components


def shingles(text: str | None, k: int = 4) -> set:
    words = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}


def brute(rows: list[tuple], percent: int) -> Counter:
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    least: dict[int, int] = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return Counter((i, len(sets[n]), least.get(find(n)) if sets[n] else i) for n, (i, _) in enumerate(rows))


def near_copies(seed: int) -> list[tuple]:
    """Texts of many lengths, with copies changed in a few words each."""
    rng, rows = random.Random(seed), []
    for _ in range(40):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([1, 3, 4, 8, 9, 12, 20, 40, 90, 200, 500]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, len(words) // 60])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            rows.append((len(rows), " ".join(copy[: len(copy) - rng.choice([0, 0, 1, 3])]) or "z"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(workers, seed):
    rows = near_copies(seed)
    docs = workers.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard.linked_documents(docs).collect())
    assert got == brute(rows, 85)


def test_edge_rows(edge, nothing):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert Counter(tuple(r) for r in jaccard.linked_documents(edge).collect()) == brute(rows, 85)
    kept = jaccard.one_of_each(edge)
    assert kept.columns == edge.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[5] == 1 and ids[8] == 0 and ids[1] == 1 and ids[2] == 1 and ids[None] == 2
    assert jaccard.linked_documents(nothing).count() == 0 and jaccard.one_of_each(nothing).count() == 0


def test_tiles_of_a_large_block_lose_nothing(workers, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 3)
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    monkeypatch.setattr(jaccard, "PER_LEADER", 2)
    monkeypatch.setattr(jaccard, "HOT_LEAST", 2)
    rows = near_copies(3)[:60]
    docs = workers.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in jaccard.linked_documents(docs).collect()) == brute(rows, 85)


@pytest.mark.parametrize("tile", [jaccard.TILE, 16])
def test_a_large_group_at_the_threshold_comes_out_as_few_links(workers, monkeypatch, tile):
    """Copies that differ from one text in many places link with some of each other."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    rng, rows = random.Random(8), []
    base = [f"w{n}" for n in range(300)]
    for n in range(150):
        copy = list(base)
        for _ in range(rng.randrange(4, 9)):
            copy[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((n, " ".join(copy)))
    docs = workers.createDataFrame(rows, "doc_id long, text string")
    found, plain = [], jaccard._between_components
    monkeypatch.setattr(jaccard, "_between_components", lambda *a: found.append(jaccard.written(plain(*a), "f")) or found[0])
    assert Counter(tuple(r) for r in jaccard.linked_documents(docs).collect()) == brute(rows, 85)
    if tile == jaccard.TILE:
        assert 0 < found[0].count() < 150


def test_joining_links_of_random_sets():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 90)), dtype=np.uint64) * np.uint64(2)
        sets += [np.unique(base[rng.random(len(base)) < keep]) for keep in (1, 0.97, 0.94, 0.9) for _ in range(3)]
    sets = [x for x in sets if len(x)]
    n = np.arange(len(sets))
    links = {(a, b) for a in n for b in n[:a] if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}

    def joined(pairs):
        root = n.copy()
        for a, b in pairs:
            root[root == root[a]] = root[b]
        return {tuple(np.flatnonzero(root == r)) for r in root}

    got = jaccard.joining_links(sets, n, n, n, 85)
    assert joined(got) == joined(links) and len(got) == len(n) - len(joined(links))
    assert jaccard.joining_links(sets, np.zeros(len(n), np.int64), n, n, 85) == []
    odd, even = n[n % 2 == 1], n[n % 2 == 0]
    across = {p for p in links if p[0] % 2 != p[1] % 2}
    assert joined(jaccard.joining_links(sets, n, even, odd, 85)) == joined(across)


def test_a_group_of_very_many_shingles_hides_no_link():
    """Counts beyond two bytes are kept whole, and sizes are exact."""
    some = np.arange(70_000, dtype=np.uint64)
    other = np.concatenate([some[:-300], np.arange(300, dtype=np.uint64) + np.uint64(1 << 63)])
    vectors = jaccard._unpacked([jaccard.group_counts(some), jaccard.group_counts(np.unique(other))])
    assert vectors.sum(axis=1).tolist() == [70_000, 70_000]
    assert list(CountTree(vectors[:1]).search(vectors[1], 85)) == [0]


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_linked_sets_share_a_block(percent):
    rng = np.random.default_rng(percent)
    for _ in range(400):
        size = int(rng.integers(6, 400))
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        changed = int(rng.integers(0, jaccard.differing(len(a), percent) + 1))
        gone = int(rng.integers(0, changed + 1))
        b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 1 << 63, changed - gone, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(np.union1d(a, b)) != both and 100 * both >= percent * len(np.union1d(a, b)):
            assert len(np.intersect1d(jaccard.block_keys(a, percent), jaccard.block_keys(b, percent)))


def test_tree_search_equals_scan():
    rng = np.random.default_rng(5)
    counts = rng.poisson(3, (700, 16)) * rng.integers(1, 4, (700, 1))
    tree = CountTree(counts)
    for q in counts[::50]:
        shared = np.minimum(counts, q).sum(axis=1)
        want = np.flatnonzero(reachable(shared, counts.sum(axis=1), int(q.sum()), 85))
        assert set(tree.search(q, 85)) == set(want)


def test_components_of_paths_stars_and_rings(workers):
    edges = [(n, n + 1) for n in range(30)] + [(100, n) for n in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r.node: r.component for r in components(workers.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[n] == 0 for n in range(31)) and all(got[n] == 100 for n in range(100, 140))
    assert got[200] == got[201] == got[202] == 200
