"""Importance resampling against a plain version; CRCs of joined strings against zlib."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import importance
from millrace.llm.crc import joined

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def buckets(words):
    return [
        zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)
    ]


def brute(docs, target):
    docs = [(i, words_of(t)) for i, t in docs]
    raw = Counter(b for _, w in docs for b in buckets(w))
    wanted = Counter(b for t in target for b in buckets(words_of(t)))
    s_all, t_all = sum(raw.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((raw[b] + 1) * (t_all + 10_000))))
    out = []
    for i, w in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, buckets(w)))
        out.append([i, len(buckets(w)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    enough = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): n + 1 for n, r in enumerate(enough[: 5 * len(enough) // 100])}
    return Counter((*r[:4], ranks.get(id(r))) for r in out)


def result(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=300), min_size=2, max_size=20))
def test_joined_crcs(strings):
    crcs = np.array([zlib.crc32(s) for s in strings], np.uint32)
    lengths = np.array([len(s) for s in strings], np.int64)
    want = [zlib.crc32(a + b) for a, b in zip(strings, strings[1:])]
    assert joined(crcs[:-1], crcs[1:], lengths[1:]).tolist() == want


@settings(max_examples=80, deadline=None)
@given(
    texts=st.lists(st.text("aB1 .é中😀\x00\x7f-_", max_size=60), max_size=8), limit=st.integers(1, 40),
    sizes=st.tuples(*[st.integers(1, 60)] * 3),
)
def test_scanned_runs_whatever_the_sizes(texts, limit, sizes):
    kept = importance.PIECE, importance.LOT, importance.LONGEST
    importance.PIECE, importance.LOT, importance.LONGEST = sizes
    try:
        dictionary, got, count = importance.Dictionary(limit), [[] for _ in texts], Counter()
        for of, run_of, bucket in importance.runs((t.encode() for t in texts), dictionary):
            count.update(of.tolist())
            for place, b in zip(run_of.tolist(), bucket.tolist()):
                got[place].append(b)
    finally:
        importance.PIECE, importance.LOT, importance.LONGEST = kept
    for n, text in enumerate(texts):
        assert count[n] == len(words_of(text)) and sorted(got[n]) == sorted(buckets(words_of(text)))


def test_equals_the_plain_version(spark, workers, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert result(importance.resampled(docs, target)) == want
    assert sum(r[4] is not None for r in want) >= 5


def test_ties_nulls_and_empty_tables(edge, nothing, workers):
    text = " ".join(["Some words"] * 15)
    rows = [(1, text)] * 70 + [(None, text)] * 30 + [(n, f"{text} {n % 3}") for n in range(100)] + [(7, None), (8, ""), (9, "...")]
    docs = workers.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, rank int, _rank int, _range string")
    target = workers.createDataFrame([("some WORDS",), (None,)], "text string")
    assert result(importance.resampled(docs, target)) == brute(rows, ["some WORDS", None])
    assert importance.resampled(nothing, target).count() == 0
    pairs = [(r.doc_id, r.text) for r in edge.collect()]
    assert result(importance.resampled(edge, nothing)) == brute(pairs, [])


@pytest.mark.parametrize("word", ["x" * 3_000_000, "中" * 400_000])
def test_one_very_long_word(word):
    dictionary = importance.Dictionary()
    of, run_of, bucket = next(importance.runs(iter([f"a {word} b".encode()]), dictionary))
    assert sorted(bucket.tolist()) == sorted(buckets(["a", word, "b"]))
