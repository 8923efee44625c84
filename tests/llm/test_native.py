"""Exact dedup, sharding and mixing: edge rows, brute force, forced hash collisions."""

from __future__ import annotations

import collections
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, mixing, rows, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, rank int, _id string"
LONG = "ent " * 3000 + "the end"
DOCS = [
    (1, "a b c", "en", "s1"), (2, "abc", "en", "s1"), (3, " a bc\n", "en", "s2"), (3, " a bc\n", "en", "s2"),
    (4, None, "en", "s2"), (5, "", "en", None), (6, "  \t", None, None), (None, "solo", "en", "s3"),
    (None, "a b  c ", "en", "s3"), (7, LONG, "en", "s1"), (8, LONG.replace(" ", ""), "en", "s1"), (9, "éé é", "fr", ""),
]
BLANK = str.maketrans("", "", rows.BLANKS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*d, 0, True, 1, "x") for d in DOCS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def groups_of(data):
    out = collections.defaultdict(list)
    for d in data:
        out[(d[1] or "").translate(BLANK)].append(d)
    return out


def best(group):
    return min(group, key=lambda d: (-len(d[1] or ""), d[0] is None, d[0] or 0))


@pytest.mark.parametrize("hashing", [F.xxhash64, lambda c: F.length(c).cast("long"), lambda c: F.lit(7).cast("long")])
def test_dedup_equals_brute_force_even_when_identifiers_collide(docs, hashing):
    got = exact_dedup.exact_duplicates(docs, rule=exact_dedup.ChunkRule(3, 8), chunk_hash=hashing).collect()
    want = collections.Counter()
    for group in groups_of(DOCS).values():
        stays, told = best(group), False
        for d in sorted(group, key=lambda d: (d[0] is None, d[0] or 0)):
            kept = not told and (d[0], len(d[1] or "")) == (stays[0], len(stays[1] or ""))
            told |= kept
            want[(d[0], stays[0], len(group), kept)] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == want


def test_chunks_join_to_the_text(spark):
    rule = exact_dedup.ChunkRule(4, 16)
    text = "xxenten" * 50 + "中文" * 40 + "😀" * 21
    df = spark.createDataFrame([(text,)], "t string")
    chunks = df.select(F.regexp_extract_all("t", F.lit(rule.pattern()), 0).alias("c")).first().c
    assert "".join(chunks) == text and max(map(len, chunks)) <= 16
    shifted = spark.createDataFrame([("yy" + text,)], "t string").select(
        F.regexp_extract_all("t", F.lit(rule.pattern()), 0).alias("c")
    ).first().c
    assert len(set(chunks) & set(shifted)) > 1, "an insertion leaves later chunks as they were"


def test_deduplicated_rows_keep_their_columns(docs, empty):
    out = exact_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    assert collections.Counter(r.doc_id for r in out.collect()) == collections.Counter(
        best(g)[0] for g in groups_of(DOCS).values()
    )
    assert exact_dedup.deduplicated(empty).count() == 0 and exact_dedup.exact_duplicates(empty).count() == 0


def test_dedup_has_no_python(docs):
    plan = exact_dedup.exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shards_hold_every_row_once_with_gapless_slots(docs, empty):
    got = sharding.assign_shards(docs, 3).collect()
    assert len(got) == len(DOCS)
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    want = collections.Counter((d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in DOCS)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert sharding.assign_shards(empty).count() == 0


def test_shards_are_near_equal_and_keep_copies_together(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sharding.assign_shards(docs, 8).collect()
    sizes = collections.Counter()
    for r in got:
        sizes[r.shard] += r.size
    even, largest = sum(sizes.values()) / 8, max(r.size for r in got)
    assert all(abs(sizes[s] - even) <= 0.02 * even + largest for s in range(8))
    homes = collections.defaultdict(set)
    for r in got:
        homes[(r.text_crc32, r.size)].add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) <= 7


def test_one_hot_text_is_parted_between_ids(spark):
    docs = spark.createDataFrame([(n, "same text" if n % 3 else f"text {n}", "s") for n in range(3000)], "doc_id long, text string, source string")
    got = sharding.assign_shards(docs, 8, tolerance=0.01).groupBy("shard").agg(F.sum("size").alias("size")).collect()
    even = sum(r["size"] for r in got) / 8
    assert len(got) == 8 and all(abs(r["size"] - even) <= 0.02 * even + 20 for r in got)


def shares(rows, shards=8):
    sizes = collections.Counter()
    for r in rows:
        sizes[r.shard] += r.size
    return [sizes[n] for n in range(shards)]


@pytest.mark.parametrize("parts", [1, 5])
def test_rows_that_agree_in_text_and_id_are_parted(spark, parts):
    rows = [(None, "one row again and again")] * 3000 + [(n, f"another text {n}") for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = sharding.assign_shards(docs, 8).collect()
    sizes = shares(got)
    assert max(sizes) - min(sizes) <= 0.01 * sum(sizes) / 8 + 2 * 24
    for n in range(8):
        assert sorted(r.slot for r in got if r.shard == n) == list(range(sum(r.shard == n for r in got)))
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((i, len(t) + 1) for i, t in rows)


def test_how_equal_rows_are_parted_does_not_depend_on_where_they_lie(spark):
    docs = spark.createDataFrame([(1, "same")] * 900 + [(n, f"text {n}") for n in range(100)], "doc_id long, text string")
    seen = [
        collections.Counter((r.doc_id, r.shard) for r in sharding.assign_shards(docs.repartition(parts), 4).collect())
        for parts in (1, 3, 8)
    ]
    assert seen[0] == seen[1] == seen[2]


@pytest.mark.parametrize("tolerance", [0.0, 0.005, 0.05])
def test_cuts_lie_where_the_sorted_sum_has_them(spark, sf_dir, tolerance):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    keyed = sharding.written(sharding.sized_keys(docs), "k")
    rows = sorted((r.text_key, r.id_key, r.copy_key, r.size) for r in keyed.collect())
    total, largest = sum(r[3] for r in rows), max(r[3] for r in rows)
    for n, cut in enumerate(sharding.find_cuts(keyed, 8, tolerance), 1):
        below = sum(r[3] for r in rows if r[:3] < (cut.text_key, cut.id_key, cut.copy_key))
        assert abs(below - total * n / 8) <= max(tolerance * total / 8, largest / 2)


def test_written_shards_keep_columns_of_any_name_and_part_equal_rows(spark, tmp_path):
    rows = [(None, "again and again", n, n, -n) for n in range(400)] + [(n, f"text {n}", n, n, n) for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, text_key int, id_key int")
    sharding.write_shards(docs, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert collections.Counter(map(tuple, back.select(docs.columns).collect())) == collections.Counter(rows)
    counts = [r["count"] for r in back.groupBy("shard_1").count().collect()]
    assert len(counts) == 4 and max(counts) - min(counts) <= 30


def test_whole_documents_are_written_by_shard(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, 3)
    back = spark.read.parquet(path)
    assert back.count() == len(DOCS) and set(docs.columns) <= set(back.columns)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_ranks_run_without_gaps_within_keys(spark, parts):
    df = spark.createDataFrame([(None if n % 7 == 0 else n % 3, n) for n in range(200)], "k long, v long").repartition(parts)
    got = collections.defaultdict(list)
    for r in rows.ranked(df, ["k"], [F.asc("v")]).collect():
        got[r.k].append((r.v, r["rank"]))
    assert all([n for _, n in sorted(v)] == list(range(len(v))) for v in got.values())


def targets_of(sizes):
    """Water filling by hand: (source -> target)."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    free, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        unit = free / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * unit > 2 * sizes[s]}
        if not above:
            return out | {s: weight[s] * unit for s in open_}
        for s in above:
            out[s] = 2.0 * sizes[s]
            free -= 2 * sizes[s]
        open_ -= above
    return out


def test_targets_and_copies(spark, sf_dir, docs, empty):
    for table in (docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        got = mixing.mix_counts(table).collect()
        assert len(got) == table.count()
        sizes, taken, target, most = collections.Counter(), collections.Counter(), {}, collections.Counter()
        for r in got:
            sizes[r.source] += r["size"]
            taken[r.source] += r.taken
            most[r.source] = max(most[r.source], r["size"])
            target[r.source] = r.target
            assert r.copies in (0, 1, 2) and r.taken == r.copies * r["size"]
        want = targets_of(sizes)
        for s in sizes:
            assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
            assert abs(taken[s] - target[s]) <= 2 * most[s] + 1
    assert mixing.mix_counts(empty).count() == 0


def test_mix_repeats_rows_and_reruns_agree(docs, empty):
    counts = collections.Counter()
    for r in mixing.mix_counts(docs).collect():
        counts[(r.doc_id, r.source)] += r.copies
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got = collections.Counter((r.doc_id, r.source) for r in out.collect())
    assert got == +counts
    assert got == collections.Counter((r.doc_id, r.source) for r in mixing.mixed(docs.repartition(5)).collect())
    assert mixing.mixed(empty).count() == 0
