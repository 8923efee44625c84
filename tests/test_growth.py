"""Steps whose memory, shuffles or writes must not outgrow their input."""

import bz2
import time
from datetime import datetime
from pathlib import Path

import pytest
from feeds import day, provider, snapshot_file, staffing_file
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from millrace.operators import quality, running, upsert
from millrace.plans import silver
from millrace.plans import standins as S
from millrace.plans.lake import STAFFING_SCHEMA, Lake
from millrace.session import scratch_root, staged, written
from millrace.sources import drops, sinks
from millrace.sources.files import PACKED_CSV, fingerprint_files, land_files, list_files
from millrace.sources.layouts import STAFFING_LAYOUT, Field


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_not_sorted_beside_a_copy_of_themselves(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 0), (2, None, 5)], "k int, a string, b int")
    latest = upsert.latest_per_key(rows, ["k"], [])
    assert "struct" not in plan(latest)
    assert sorted(map(tuple, latest.collect())) == [(1, "b", 0), (2, None, 5)]


def test_columns_are_told_of_broken_rows_only(spark):
    fields = [Field("a", "decimal(4,2)"), Field("b", "int"), Field("c", "varchar(1)")]
    rows = spark.createDataFrame(
        [(" 12.345 ", "7", "x"), ("1e3", "x", "xy"), (None, None, None), (".5", "2147483648", "x")], "a string, b string, c string"
    )
    checked = quality.check_types(rows, fields)
    assert "exists(" in plan(checked)
    assert [[v.column for v in r[quality.VIOLATIONS]] for r in checked.collect()] == [[], ["a", "b", "c"], [], ["b"]]
    typed = quality.apply_types(rows, fields).collect()
    assert [str(r.a) for r in typed] == ["12.34", "None", "None", "0.50"] and [r.b for r in typed] == [7, None, None, None]


def test_feed_files_stay_of_one_size(spark, tmp_path, monkeypatch):
    line = [(n, n % 7, n % 8, 1, 5.0, "R", "F", datetime(1996, 1, 1 + n % 28)) for n in range(200)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(line, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    few = S.staffing_files(spark, str(tmp_path))
    monkeypatch.setattr(S, "FILE_ROWS", 10)
    many = S.staffing_files(spark, str(tmp_path))
    assert few.select("file_name").distinct().count() == 4
    assert many.select("file_name").distinct().count() == 20
    assert sorted(many.drop("file_name").collect()) == sorted(few.drop("file_name").collect())


def test_republish_writes_rows_once(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/table"
    sinks.write_partitions(spark.range(6).withColumn("p", F.col("id") % 3), path, "p")
    stored = spark.read.parquet(path)
    writes, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(type(stored.write), "parquet", lambda self, to, *a, **b: (writes.append(to), write(self, to, *a, **b))[1])
    sinks.republish(stored.where("p = 1").withColumn("id", F.col("id") + 10), path, "p")
    assert len(writes) == 1
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 3, 5, 11, 14]
    assert [f.name for f in tmp_path.iterdir()] == ["table"]


def test_months_are_filled_without_a_hash_table(spark):
    days = spark.createDataFrame(
        [("a", 202401, 3, 1.0, None), ("a", 202403, None, 2.0, 1.0), (None, 202403, 4, 1.0, 0.0)],
        "provnum string, month_key int, mdscensus int, total_direct_care_hours double, contract_direct_care_hours double",
    )
    sums = running.running_sums(days)
    assert plan(sums).count("Aggregate ") == 2
    got = sorted((r.provnum or "", r.month_key, r.reporting_days, r.sum_census, r.known_census) for r in sums.collect())
    assert got == [("", 202403, 1, 4, 1), ("a", 202401, 1, 3, 1), ("a", 202402, 1, 3, 1), ("a", 202403, 2, 3, 1)]


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.rpartition("/")[2] for f in disk.getAllFiles().mkString("\n").splitlines() if "shuffle_" in f}


def test_shuffle_files_go_with_the_query_that_wrote_them(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(1000).withColumn("p", F.col("id") % 3)
    assert len(written(rows.repartition(5, "id"), "shuffled").collect()) == 1000
    sinks.write_partitions(rows, f"{tmp_path}/table", "p")
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") != "true"


def test_staged_rows_go_with_their_block(spark):
    with pytest.raises(ValueError, match="stop"), staged(spark.range(3), "kept") as rows:
        folder = Path(rows.inputFiles()[0].removeprefix("file://")).parent
        assert rows.count() == 3 and folder.exists()
        raise ValueError("stop")
    assert not folder.exists()


def test_a_run_leaves_neither_parsed_nor_merged_rows_behind(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    staffing_file(tmp_path / "drop", "PBJ_Daily_Nurse_Staffing_a.csv", [day("1", 20240101), day("2", 20240201)], "2024-05-01T00:00:00")
    snapshot_file(tmp_path / "drop", "NH_ProviderInfo_Jan2024.csv", [provider("1")], "2024-05-01T00:00:00")
    lake = Lake(spark, str(tmp_path / "lake"))
    before = {f.name for f in Path(scratch_root(spark)).iterdir()}
    run = silver.ingest(lake, fingerprint_files(spark, str(tmp_path / "drop")))
    left = {f.name.partition("-")[0] for f in Path(scratch_root(spark)).iterdir() if f.name not in before}
    assert not left & {"parsed", "batch"}
    assert lake.staffing.count() == 2 and lake.snapshots.count() == 1
    assert sorted(r.month_key for r in run.months.collect()) == [202401, 202402]
    assert [r.provnum for r in run.providers.collect()] == ["1"]


def test_landed_copies_are_packed_and_still_split(spark, tmp_path, monkeypatch):
    lines = [day(str(n), 20240101, provname=f"Home, {n * 7919 % 100003}", hrs_rn=n % 100) for n in range(30_000)]
    source = staffing_file(tmp_path, "PBJ_a [1].csv", lines, "2024-05-01T00:00:00")
    listed = list_files(spark, str(tmp_path)).withColumn("s3_key", F.lit("PBJ a_1.csv"))
    assert land_files(listed, f"{tmp_path}/bronze").collect()[0].file_name == "PBJ_a [1].csv"
    copies = [f for f in (tmp_path / "bronze").iterdir() if f.suffix != ".crc"]
    assert [f.name for f in copies] == ["PBJ a_1.csv.bz2"]
    assert bz2.decompress(copies[0].read_bytes()) == source.read_bytes()
    assert copies[0].stat().st_size * 4 < source.stat().st_size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        got = drops.read_feed(spark, f"{tmp_path}/bronze", STAFFING_LAYOUT, PACKED_CSV)
        assert got.select(F.spark_partition_id()).distinct().count() > 1
        want = drops.read_feed(spark, str(source).replace("[", "\\[").replace("]", "\\]"), STAFFING_LAYOUT)
        columns = [*STAFFING_LAYOUT.names, drops.MALFORMED]
        assert want.count() == got.count() == 30_000
        assert want.select(columns).exceptAll(got.select(columns)).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_are_sent_in_rounds(spark, tmp_path, monkeypatch):
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("provnum"), F.lit(20240101).alias("workdate"),
        F.when(F.col("id") % 20 > 0, F.concat(F.lit("PBJ_"), (F.col("id") % 20).cast("string"), F.lit(".csv"))).alias("file_name"),
    )
    rounds, send = [], S._send
    monkeypatch.setattr(S, "_send", lambda part, *a: (rounds.append({r[0] for r in part.select("file_name").distinct().collect()}), send(part, *a)))
    for stamp in (1_717_200_000_000, 1_717_300_000_000):
        S.send_files(rows, STAFFING_LAYOUT, f"{tmp_path}/drop", stamp)
    assert len(rounds) == 2 * S.ROUNDS and sum(map(len, rounds)) == 40 and max(map(len, rounds)) < 20
    files = [f for f in (tmp_path / "drop").iterdir() if not f.name.endswith(".crc")]
    assert len(files) == 20 and {f.stat().st_mtime for f in files} == {1_717_300_000.0}
    got = [line.split(",")[0] for f in files for line in f.read_text().splitlines()[1:]]
    assert sorted(got, key=int) == [str(n) for n in range(400)]
    assert [f.name for f in tmp_path.iterdir()] == ["drop"]


def test_a_merge_into_an_empty_table_shuffles_no_join(spark, tmp_path):
    stored = Lake(spark, str(tmp_path / "lake")).staffing
    assert "LocalRelation <empty>" in plan(stored) and stored.isEmpty()
    keys = ["provnum", "workdate"]
    batch = spark.createDataFrame([("1", 20240101)], "provnum string, workdate int").select(
        *[(F.col(c) if c in keys else F.lit(None)).cast(t).alias(c) for c, t in stored.dtypes]
    )
    merged = upsert.upsert_latest(silver.touched(stored, batch, "month_key"), batch, keys, silver.STAMP, silver.DIGEST)
    assert "Join" not in plan(merged)
    assert merged.collect() == batch.collect() and merged.columns == batch.columns
    assert spark.createDataFrame([], STAFFING_SCHEMA).schema.names == stored.columns


def test_stored_rows_are_not_shuffled_by_the_months_reached(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("1", 1, "a", "x"), ("2", 2, "a", "x")], "k string, p int, stamp string, digest string")
    path, asked, touched = f"{tmp_path}/table", [], silver.touched
    monkeypatch.setattr(silver, "touched", lambda table, batch, by: (asked.append(batch), touched(table, batch, by))[1])
    for _ in range(2):
        reached = silver.merge_rows(rows, path, ["k"], "p", "stamp", "digest")
    assert all("Aggregate" not in plan(batch) and batch.columns == ["p"] for batch in asked)
    assert sorted(r.p for r in reached.collect()) == [1, 2]
    assert sorted(map(tuple, spark.read.parquet(path).select(rows.columns).collect())) == sorted(map(tuple, rows.collect()))
