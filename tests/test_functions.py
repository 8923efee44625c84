"""Scalar functions on edge values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.functions import keys, numbers, outcomes, text
from millrace.operators import ledger as L


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("v")).first().v


@pytest.mark.parametrize(("name", "kind", "period", "refused"), [
    ("NH_ProviderInfo_Oct2024.csv", text.SNAPSHOT, 20241001, False),
    ("nh_providerinfo_OCT2024 (1).csv", text.SNAPSHOT, 20241001, False),
    ("NH_ProviderInfo_Xyz2024.csv", text.SNAPSHOT, None, True),
    ("PBJ_Daily_Nurse_Staffing_Q2_2024.csv", text.STAFFING, None, False),
    ("pbj_daily_nurse_staffing_.CSV", text.STAFFING, None, False),
    ("budget.csv", None, None, True),
    ("NH_ProviderInfo_Oct2024.csv.bak", None, None, True),
])
def test_names(spark, name, kind, period, refused):
    row = L.classify(spark.createDataFrame([(name,)], "file_name string")).first()
    assert (row.file_type, row.snapshot_date_key, row.name_error is not None) == (kind, period, refused)


@pytest.mark.parametrize(("name", "stamp", "expected"), [
    ("f.csv", "2024-06-15T10:30:00.000Z", "f_20240615_103000.csv"),
    ("f.CSV", "2024-06-15T10:30:00+05:30", "f_20240615_103000.csv"),
    ("f.csv", "", None),
    ("f.csv", "yesterday", None),
])
def test_landing_name(spark, name, stamp, expected):
    assert one(spark, text.landing_name("n", "s"), n=name, s=stamp) == expected


def test_landing_name_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(spark, text.landing_name("n", "s"), n="f.csv", s="2024-03-10T02:30:00Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == "f_20240310_023000.csv"


@pytest.mark.parametrize(("path", "expected"), [
    ("stage/2024 Sales-Report.csv.gz", "T_2024_SALES_REPORT"),
    ("a/b/__x--y.CSV", "X_Y"),
    ("plain", "PLAIN"),
])
def test_table_name(spark, path, expected):
    assert one(spark, text.table_name("p"), p=path) == expected


def test_blank_and_undecodable(spark):
    df = spark.createDataFrame([("  ", "", " a ", 1)], "a string, b string, c string, d int")
    assert tuple(text.blanks_to_null(df).first()) == (None, None, " a ", 1)
    assert one(spark, text.replace_undecodable("s"), s="St Mary�s") == "St Mary?s"


def test_calendar_keys(spark):
    assert one(spark, keys.month_key("k"), k=20240630) == 202406
    assert one(spark, keys.first_day_key("k"), k=202406) == 20240601
    assert one(spark, keys.month_label("k"), k=202406) == "2024-06"
    assert str(one(spark, keys.date_of("k"), k=20240229)) == "2024-02-29"
    assert one(spark, keys.date_of("k"), k=20230229) is None
    assert one(spark, keys.date_of("k"), k=123) is None


def test_surrogate_keys_are_unique_and_never_negative(spark):
    key = keys.surrogate_key(F.col("id").cast("string"), F.lit(202401))
    row = spark.range(50_000).select(key.alias("k")).agg(F.count_distinct("k").alias("n"), F.min("k").alias("low")).first()
    assert row.n == 50_000 and row.low >= 0


@pytest.mark.parametrize(("num", "den", "expected"), [(6.0, 3.0, 2.0), (1.0, 0.0, None), (1.0, None, None), (1.0, -1.0, None)])
def test_ratio(spark, num, den, expected):
    row = spark.createDataFrame([(num, den)], "n double, d double")
    assert row.select(numbers.ratio("n", "d").alias("v")).first().v == expected


def test_sum_of_nulls_keeps_precision(spark):
    df = spark.createDataFrame([(None, None), (None, 2)], "a int, b int")
    df = df.select(F.col("a").cast("decimal(5,2)"), F.col("b").cast("decimal(7,2)"))
    out = df.select(numbers.sum_of(["a", "b"], "decimal(9,2)").alias("v"))
    assert out.schema["v"].dataType.simpleString() == "decimal(9,2)"
    assert [float(r.v) for r in out.collect()] == [0.0, 2.0]


@pytest.mark.parametrize(("status", "error", "attempt", "expected"), [
    ("FINISHED", None, 1, "NEXT"), ("ABORTED", None, 1, "REJECT"),
    ("FAILED", "x DATA_ERROR | y", 1, "REJECT"), ("FAILED", "timeout", 1, "RETRY"),
    ("FAILED", "timeout", 2, "REJECT"), ("FAILED", None, 1, "RETRY"), ("STARTED", None, 1, "WAIT"),
])
def test_route(spark, status, error, attempt, expected):
    df = spark.createDataFrame([(status, error, attempt)], "s string, e string, a int")
    assert df.select(outcomes.route("s", "e", "a").alias("v")).first().v == expected


def test_error_class(spark):
    assert one(spark, outcomes.tagged_error("m", "s"), m="Value OUT OF RANGE", s="f.csv") == (
        "DATA_ERROR | Value OUT OF RANGE | source: f.csv"
    )
    assert one(spark, outcomes.tagged_error("m"), m="connection lost") == "connection lost"


def test_change_states(spark):
    manifest = spark.createDataFrame([(i, f"m{i}") for i in "abcde"], "file_id string, md5hash string")
    known = spark.createDataFrame(
        [("a", "ma", "SUCCESS"), ("b", "mb", "FAILED"), ("c", "old", "SUCCESS"), ("e", "me", None)],
        "file_id string, md5hash string, merge_status string",
    )
    got = {r.file_id: r.change for r in L.detect_changes(manifest, known).collect()}
    assert got == {"a": "SKIP", "b": "RETRY", "c": "CHANGED", "d": "NEW", "e": "RETRY"}


def test_unreadable_stamp_is_an_error_unless_skipped(spark):
    names = "PBJ_Daily_Nurse_Staffing_1.csv"
    manifest = spark.createDataFrame(
        [("a", names, "", "m"), ("b", names, "", "m")], "file_id string, file_name string, modified_at string, md5hash string"
    )
    known = spark.createDataFrame([("b", "m", "SUCCESS")], "file_id string, md5hash string, merge_status string")
    got = {r.file_id: r.outcome for r in L.plan_files(manifest, known).collect()}
    assert got == {"a": "errors", "b": "skipped"}
