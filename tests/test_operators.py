"""Operators on edge rows and against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import calendar, distribution, facts, history, metrics, profiling, quality, upsert
from millrace.sources.layouts import SNAPSHOT_LAYOUT, STAFFING_LAYOUT, Field

ROW = "provnum string, workdate int, v int, stamp string, md5 string"
KEY = ["provnum", "workdate"]


def table(spark, rows):
    return spark.createDataFrame(rows, ROW)


# --- upsert ----------------------------------------------------------------


def test_win_rule(spark):
    target = table(spark, [(k, 1, 0, s, "m") for k, s in
                           [("newer", "1"), ("greater", "2"), ("same", "2"), ("older", "3"), ("unset", None), ("kept", "1")]])
    batch = table(spark, [(k, 1, 1, "2", d) for k, d in
                          [("newer", "a"), ("greater", "n"), ("same", "m"), ("older", "z"), ("unset", "z"), ("absent", "a")]])
    after = upsert.upsert_latest(target, batch, KEY, "stamp", "md5")
    got = {r.provnum: r.v for r in after.collect()}
    assert got == {"newer": 1, "greater": 1, "same": 0, "older": 0, "unset": 0, "kept": 0, "absent": 1}
    winners = upsert.merge_candidates(target, batch, KEY, "stamp", "md5")
    assert {r.provnum for r in winners.collect()} == {"newer", "greater", "absent"}
    again = upsert.upsert_latest(after, batch, KEY, "stamp", "md5")
    assert sorted(again.collect()) == sorted(after.collect())


def test_merge_does_not_depend_on_file_order(spark):
    rng = random.Random(1)
    files = [
        table(spark, [(str(k), 1, rng.randrange(99), f"2024-0{rng.randrange(1, 9)}", f"m{n}") for k in range(30)])
        for n in range(3)
    ]
    results = []
    for order in ([0, 1, 2], [2, 0, 1], [1, 2, 0]):
        state = table(spark, [])
        for n in order:
            state = upsert.upsert_latest(state, files[n], KEY, "stamp", "md5")
        results.append(sorted(map(tuple, state.collect())))
    union = files[0].union(files[1]).union(files[2])
    batch = upsert.latest_per_key(union, KEY, [F.col("stamp").desc(), F.col("md5").desc()])
    results.append(sorted(map(tuple, batch.collect())))
    assert all(r == results[0] for r in results)


def test_latest_per_key_drops_null_keys_and_breaks_ties(spark):
    rows = [("a", 1, 5, "1", "m"), ("a", 1, 7, "1", "m"), (None, 1, 1, "1", "m"), ("a", None, 1, "1", "m")]
    order = [F.col("stamp").desc(), F.col("md5").desc()]
    for n in (1, 4):
        got = upsert.latest_per_key(table(spark, rows).repartition(n), KEY, order).collect()
        assert [(r.provnum, r.v) for r in got] == [("a", 7)]


def test_latest_per_key_limits_before_the_shuffle(spark):
    """One key holding a third of the rows sends one row per map task."""
    hot = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    out = upsert.latest_per_key(hot, ["k"], [F.col("id").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning(k"):]
    assert "WindowGroupLimit" in before
    assert out.where("k = 'hot'").first().id == 29_997 and out.count() == 20_001


def test_snapshot_replace(spark):
    stored = table(spark, [("a", 202401, 1, "5", "m"), ("b", 202401, 1, "5", "m"), ("a", 202402, 1, "5", "m")])
    batch = table(spark, [("a", 202401, 2, "3", "m"), ("c", 202401, 2, "3", "m")])
    args = (["provnum"], "workdate", [F.col("stamp").desc()])
    got = {(r.provnum, r.workdate): r.v for r in upsert.replace_snapshots(stored, batch, *args).collect()}
    assert got == {("a", 202401): 2, ("b", 202401): 1, ("a", 202402): 1, ("c", 202401): 2}
    newest = upsert.replace_snapshots(stored, batch, *args, newest_wins="stamp")
    assert {(r.provnum, r.workdate): r.v for r in newest.collect()}["a", 202401] == 1


# --- history ---------------------------------------------------------------


def versions(spark, rows, **kw):
    df = spark.createDataFrame(rows, "k string, t int, x string, y string")
    out = history.version_history(df, "k", "t", ["x", "y"], **kw)
    return {(r.k, r.month_key): (r.effective_from, r.effective_to, r.is_current) for r in out.collect()}


def test_versions(spark):
    rows = [("a", 20240101, "A", "1"), ("a", 20240201, "A", "1"), ("a", 20240301, "B", "1"), ("a", 20240401, "A", "1")]
    assert versions(spark, rows) == {
        ("a", 202401): (202401, 202402, False), ("a", 202402): (202401, 202402, False),
        ("a", 202403): (202403, 202403, False), ("a", 202404): (202404, None, True),
    }


def test_versions_with_nulls_gaps_and_vanished_keys(spark):
    rows = [
        ("n", 20240101, None, None), ("n", 20240201, "v", None), ("n", 20240301, None, None),
        ("g", 20240101, "A", "1"), ("g", 20240601, "A", "1"),
    ]
    got = versions(spark, rows)
    assert got["n", 202401] == (202401, 202401, False) and got["n", 202403] == (202403, None, True)
    assert got["g", 202401] == got["g", 202406] == (202401, None, True)
    by_all = versions(spark, rows, as_of="global")
    assert by_all["n", 202403] == (202403, 202403, False) and by_all["g", 202406] == (202401, None, True)


def test_versions_against_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (f"k{k}", 20200001 + m // 12 * 10000 + (m % 12 + 1) * 100, rng.choice(["A", "B", None]), rng.choice(["1", None]))
        for k in range(20) for m in range(36) if rng.random() < 0.8
    ]
    want = {}
    for k in {r[0] for r in rows}:
        groups = []
        for _, t, x, y in sorted(r for r in rows if r[0] == k):
            if not groups or groups[-1][0] != (x, y):
                groups.append(((x, y), []))
            groups[-1][1].append(t // 100)
        for n, (_, months) in enumerate(groups):
            last = n == len(groups) - 1
            for m in months:
                want[k, m] = (months[0], None if last else months[-1], last)
    assert versions(spark, rows) == want


def test_history_needs_one_shuffle(spark):
    df = spark.createDataFrame([("a", 20240101, "A", "1")], "k string, t int, x string, y string")
    plan = history.version_history(df, "k", "t", ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_lookup_keeps_rows_and_defaults(spark):
    dim = spark.createDataFrame([(5, "a", 202401)], "provider_key long, provnum string, month_key int")
    fact = spark.createDataFrame([("a", 202401), ("a", 202402), ("b", 202401)], "provnum string, month_key int")
    got = facts.lookup(fact, dim, ["provnum", "month_key"], "provider_key").collect()
    assert sorted(r.provider_key for r in got) == [-1, -1, 5]


# --- quality ---------------------------------------------------------------


@pytest.mark.parametrize(("kind", "value", "rule"), [
    ("decimal(4,2)", "999.99", "type"), ("decimal(4,2)", "12.345", None), ("smallint", "40000", "type"),
    ("smallint", "-32768", None), ("int", "x", "type"), ("varchar(2)", "abc", "length"), ("varchar(2)", "é", None),
    ("varchar(2)", "éa", "length"), ("boolean", "Y", None), ("boolean", "maybe", "type"), ("date", "2024-02-30", "type"),
    ("int", None, None), ("int", " -2147483648 ", None), ("int", "2147483648", "type"), ("int", "12.5", "type"),
    ("int", "00000000000000000000007", None), ("bigint", "9223372036854775807", None),
    ("bigint", "9223372036854775808", "type"), ("boolean", " FALSE ", None), ("boolean", "2", "type"),
])
def test_type_rules(spark, kind, value, rule):
    df = spark.createDataFrame([(value,)], "c string")
    found = quality.check_types(df, [Field("c", kind)]).first()[quality.VIOLATIONS]
    assert [v.rule for v in found] == ([rule] if rule else [])


def test_cut_decimals_and_required(spark):
    fields = [Field("a", "decimal(4,2)"), Field("b", "varchar(5)")]
    df = spark.createDataFrame([("12.345", None)], "a string, b string")
    assert str(quality.apply_types(df, fields).first().a) == "12.34"
    (violation,) = quality.check_types(df, fields, ["b"]).first()[quality.VIOLATIONS]
    assert (violation.column, violation.rule) == ("b", "not_null")


def test_files_load_whole_or_not_at_all(spark):
    df = spark.createDataFrame([("f", "1"), ("f", "x"), ("g", "2")], "file string, c string")
    bad = quality.bad_files(quality.check_types(df, [Field("c", "int")]), "file")
    assert [(r.file, r.bad_rows) for r in bad.collect()] == [("f", 1)]
    assert [r.c for r in quality.without_files(df, bad, "file").collect()] == ["2"]


def test_layout_sizes():
    assert (len(STAFFING_LAYOUT.fields), len(SNAPSHOT_LAYOUT.fields)) == (33, 103)


@pytest.mark.parametrize(("kind", "value", "want"), [
    ("decimal(5,2)", "-1.999", "-1.99"), ("decimal(5,2)", " .5 ", "0.50"), ("decimal(5,2)", "7.", "7.00"),
    ("decimal(5,2)", "1e2", None), ("decimal(5,2)", "1000.001", None), ("decimal(4,0)", "12.9", "12"),
    ("date", "2024-05-01", "2024-05-01"), ("date", "2024", None), ("date", "2024-5", None), ("date", "2024-13-01", None),
])
def test_conversions_follow_copy(spark, kind, value, want):
    df = spark.createDataFrame([(value,)], "c string")
    got = quality.apply_types(df, [Field("c", kind)]).first().c
    assert (None if got is None else str(got)) == want


# --- distribution ----------------------------------------------------------


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 0.99, 1.0])
@pytest.mark.parametrize("shape", ["spread", "hot", "tiny"])
def test_quantile_equals_numpy(spark, q, shape):
    rng = np.random.default_rng(3)
    values = {"spread": rng.lognormal(0, 3, 5000), "hot": np.where(rng.random(5000) < 0.4, 1.0, rng.random(5000)),
              "tiny": np.array([1.0, 2.0, 3.0, 4.0])}[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
    got = distribution.quantiles(df, {"x": q})["x"]
    assert got == pytest.approx(float(np.quantile(values, q)), rel=1e-12)


def test_quantile_is_exact_when_the_bracket_misses(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    monkeypatch.setattr(distribution.F, "percentile_approx", lambda c, *_: F.array(F.lit(900.0), F.lit(901.0)))
    assert distribution.quantiles(df, {"x": 0.25})["x"] == 249.75


def test_two_quantiles_take_three_jobs(spark):
    rng = np.random.default_rng(4)
    values = list(zip(rng.lognormal(0, 1, 20_000).tolist(), rng.random(20_000).tolist()))
    df = spark.createDataFrame(values, "x double, y double").repartition(5).cache()
    df.count()
    tracker, group = spark.sparkContext.statusTracker(), "two quantiles"
    spark.sparkContext.setJobGroup(group, group)
    got = distribution.quantiles(df, {"x": 0.1, "y": 0.9})
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("others", "others")
    assert got["x"] == pytest.approx(float(np.quantile([v for v, _ in values], 0.1)), rel=1e-12)
    assert got["y"] == pytest.approx(float(np.quantile([v for _, v in values], 0.9)), rel=1e-12)
    assert jobs <= 6, "an aggregation is two jobs with adaptive execution, a counting pass runs once for all columns"


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert distribution.quantiles(df, {"x": 0.5, "y": 0.5}) == {"x": None, "y": 1.0}


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 1, 39.9, 40]] + [(None,)], "x double")
    assert {r.bin: r.facilities for r in distribution.histogram(df, "x").collect()} == {0: 1, 1: 2, 39: 2}
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [(r.bin, r.facilities) for r in distribution.histogram(flat, "x").collect()] == [(0, 2)]


def test_outlier_bands(spark):
    rows = [("a", 2.99, 0.1), ("b", 3.0, 0.1), ("c", 3.48, 0.1), ("d", 5.0, 0.9), ("e", 5.0, None)]
    df = spark.createDataFrame(rows, "provnum string, hprd double, contract_mix double")
    got = [(r.provnum, r.flag) for r in distribution.flag_outliers(df).collect()]
    assert got == [("a", "critical"), ("b", "serious"), ("d", "serious")]


# --- metrics ---------------------------------------------------------------

FACT = "provnum string, month_key int, mdscensus smallint, total_direct_care_hours decimal(9,2), contract_direct_care_hours decimal(9,2)"


def test_facility_ratios_guard_denominators(spark):
    from decimal import Decimal as D

    days = spark.createDataFrame(
        [("zero", 202401, 0, D(5), D(1)), ("null", 202401, None, D(5), D(1)), ("idle", 202401, 9, D(0), D(0)),
         ("ok", 202401, 10, D(40), D(10)), ("ok", 202401, 30, D(80), D(20))], FACT)
    attrs = spark.createDataFrame([("ok", 0), ("idle", 10)], "provnum string, certified_beds int")
    got = {r.provnum: r for r in metrics.facility_metrics(days, attrs).collect()}
    assert got["zero"].hprd is None and got["null"].hprd is None and got["idle"].contract_mix is None
    assert (got["ok"].hprd, got["ok"].contract_mix, got["ok"].contract_reliance) == (3.0, 0.25, None)
    assert (got["ok"].avg_census, got["ok"].reporting_days) == (20.0, 2)
    shown = metrics.filter_facilities(metrics.facility_metrics(days, attrs), min_days=1)
    assert {r.provnum for r in shown.collect()} == {"ok", "idle"}


def test_bounds_and_months(spark):
    none = spark.createDataFrame([], "month_key int")
    assert tuple(metrics.month_bounds(none).first()) == (0, 0)
    some = spark.createDataFrame([(202402,), (202311,)], "month_key int")
    months = [r.month_key for r in metrics.month_list(metrics.month_bounds(some)).orderBy("month_key").collect()]
    assert months == [202311, 202312, 202401, 202402]


def test_range_prunes_partitions(spark, tmp_path):
    spark.range(10).select("id", (F.lit(202401) + F.col("id") % 3).cast("int").alias("month_key")).write.partitionBy(
        "month_key").parquet(str(tmp_path / "t"))
    df = metrics.in_months(spark.read.parquet(str(tmp_path / "t")), 202402, 202402)
    assert "PartitionFilters: [isnotnull(month_key" in df._jdf.queryExecution().executedPlan().toString()


# --- calendar and profiling ------------------------------------------------


def test_calendar_edges(spark):
    rows = {r.date_key: r for r in calendar.dim_date(spark, "2000-02-28", "2000-03-01").collect()}
    assert set(rows) == {20000228, 20000229, 20000301} and rows[20000229].is_leap_year
    (last,) = calendar.dim_date(spark, "2024-12-30", "2024-12-30").collect()
    assert (last.week_of_year, last.day_of_week, last.day_name, last.quarter_name) == (1, 1, "Monday", "Q4")
    assert not calendar.dim_date(spark, "1900-01-01", "1900-01-01").first().is_leap_year
    assert calendar.dim_date(spark, "2024-01-02", "2024-01-01").count() == 0
    assert calendar.date_spine(spark, "1000-01-01", "2024-01-01").count() == 374009


def test_calendar_join_keeps_every_fact(spark):
    facts = spark.createDataFrame([(20240101, 1), (20240101, 2), (20240301, 3), (None, 4)], "date_key int, v int")
    joined = calendar.join_calendar(facts, calendar.calendar_of(facts))
    assert sorted(r.v for r in joined.collect()) == [1, 2, 3, 4]
    assert calendar.calendar_of(facts).count() == 61
    short = calendar.join_calendar(facts, calendar.dim_date(spark, "2024-01-01", "2024-01-31"))
    assert sum(r.year is None for r in short.collect()) == 2


def test_full_duplicates_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, None), (2, 2)], "a int, b int")
    assert profiling.full_duplicates(df).first().full_dup_rows == 1
    assert profiling.full_duplicates(df.where("false")).first().full_dup_rows == 0


def test_profile(spark):
    long = "x" * 100
    df = spark.createDataFrame([(0.0, long, None), (-0.0, long, None), (1.0, None, None)], "a double, b string, c int")
    for approximate in (False, True):
        got = {r.column_name: r for r in profiling.column_profile(df, approximate).collect()}
        assert (got["a"].distinct_values, got["a"].non_null) == (2, 3)
        assert (got["b"].distinct_values, got["b"].nulls, got["b"].null_pct) == (1, 1, 33.33)
        assert (got["c"].distinct_values, got["c"].non_null, got["c"].null_pct) == (0, 0, 100.0)


def test_grain(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, d int")
    got = {r.candidate: (r.duplicate_keys, r.is_grain) for r in
           profiling.grain_test(df, [["k"], ["d"], ["k", "d"]]).collect()}
    assert got == {"k": (1, False), "d": (1, False), "k+d": (0, True)}
