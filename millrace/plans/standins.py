"""The pipeline's tables derived from the TPC-H-like test tables.

Column formulas give every edge case rows: repeated keys, NULL measures,
missing snapshots, missing stamps. Remainders below set values and states of
derived rows; no query runs on a sample.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.keys import day_key_of, month_key
from millrace.operators.upsert import latest_per_key
from millrace.session import passing_shuffles, staged
from millrace.sources.layouts import Layout
from millrace.sources.sinks import file_system


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staffing_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-grain staffing with repeated (provnum, workdate) keys."""
    returned, final = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("provnum"),
        day_key_of("l_shipdate").alias("workdate"),
        F.when(order % 97 != 0, order % 120).cast("smallint").alias("mdscensus"),
        F.col("l_quantity").cast("decimal(5,2)").alias("hrs_rn"),
        F.when(part % 11 != 0, part % 60).cast("decimal(7,2)").alias("hrs_lpn"),
        (order % 260).cast("decimal(6,2)").alias("hrs_cna"),
        F.when(returned, F.col("l_quantity")).otherwise(0.0).cast("decimal(5,2)").alias("hrs_rn_ctr"),
        F.when(returned, part % 60).cast("decimal(7,2)").alias("hrs_lpn_ctr"),
        F.when(final, order % 260).otherwise(0).cast("decimal(5,2)").alias("hrs_cna_ctr"),
        "l_orderkey", "l_linenumber", "l_partkey",
    )


def staffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (provnum, workdate)."""
    order = [F.col(c).desc() for c in ("l_orderkey", "l_linenumber", "l_partkey", "hrs_rn")]
    return latest_per_key(staffing_raw(spark, sf_dir), ["provnum", "workdate"], order, order_is_total=True)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month snapshots per provider, some months missing: their line items
    belong to the month after.

    Line items fold to (supplier, month) before they meet the suppliers. Flags
    are one character, aggregated by code: numeric buffers hash where text
    buffers would sort every row.
    """
    own = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    after = F.add_months("l_shipdate", 1)
    month = (
        F.when((F.col("l_suppkey") * 31 + own) % 13 != 0, own)
        .otherwise(F.year(after) * 100 + F.month(after)).alias("mk")
    )
    monthly = (
        table(spark, sf_dir, "lineitem")
        .select("l_suppkey", month, "l_returnflag", "l_linestatus")
        .groupBy("l_suppkey", "mk")
        .agg(
            F.max(F.ascii("l_returnflag")).alias("flag"), F.min(F.ascii("l_linestatus")).alias("status"),
            F.count("*").alias("n"),
        )
        .withColumns({"flag": F.chr("flag"), "provider_type": F.chr("status")})
    )
    suppliers = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", "s_name", "n_name")
    return monthly.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_suppkey").cast("string").alias("provnum"),
        (F.col("mk") * 100 + 1).cast("int").alias("snapshot_date_key"),
        F.col("s_name").alias("provider_name"),
        F.when(F.col("flag") == "R", "addr").alias("provider_address"),
        F.col("n_name").alias("state"),
        F.col("flag").alias("ownership_type"),
        "provider_type",
        F.when(F.col("n") > 9, 120).when(F.col("n") <= 8, 60).cast("smallint").alias("certified_beds"),
    )


def quality_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots with rating and deficiency columns, some NULL."""
    n, mk = F.col("provnum").cast("long"), month_key("snapshot_date_key")
    return snapshots(spark, sf_dir).select(
        "*",
        ((n * 7 + mk) % 5 + 1).cast("smallint").alias("overall_rating"),
        F.when(n % 4 != 0, n % 12).cast("smallint").alias("cycle1_total_health_deficiencies"),
        (mk % 7).cast("smallint").alias("cycle2_total_health_deficiencies"),
        F.when(mk % 3 != 0, 2).cast("smallint").alias("cycle3_total_health_deficiencies"),
    )


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows with stamps, some NULL."""
    order = F.col("l_orderkey")
    stamp = F.concat(F.lit("2024-01-0"), (order % 5 + 1).cast("string"))
    return staffing(spark, sf_dir).where(order % 3 != 0).select(
        "provnum", "workdate", "hrs_rn",
        F.when(order % 11 != 0, stamp).alias("stamp"),
        F.md5(order.cast("string")).alias("md5hash"),
    )


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incoming file's rows: every key not yet stored, and some that are."""
    new = F.col("l_orderkey") % 3 == 0
    return staffing(spark, sf_dir).where(new | (F.col("l_partkey") % 2 == 0)).select(
        "provnum", "workdate",
        (F.col("hrs_rn") + 1).cast("decimal(6,2)").alias("hrs_rn"),
        F.lit("2024-01-03").alias("stamp"),
        F.md5(F.lit("incoming")).alias("md5hash"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listed file per document: names of both feeds, bad ones included."""
    doc, month = F.col("doc_id"), F.col("doc_id") % 13
    names = F.array(*[F.lit(m) for m in (
        "Jan", "FEB", "mar", "Apr", "May", "Jun", "JUL", "Aug", "Sep", "Oct", "Nov", "dec", "Xyz",
    )])
    abbreviation = F.element_at(names, (month + 1).cast("int"))
    year = (doc % 20 + 2005).cast("string")
    name = (
        F.when(doc % 4 == 0, F.concat(F.lit("NH_ProviderInfo_"), abbreviation, year, F.lit(".csv")))
        .when(doc % 4 == 1, F.concat(F.lit("nh_providerinfo_"), abbreviation, year, F.lit(" (1).CSV")))
        .when(doc % 4 == 2, F.concat(F.lit("PBJ_Daily_Nurse_Staffing_Q2_"), year, F.lit(".csv")))
        .otherwise(F.concat(F.col("source"), F.lit("_"), F.col("lang"), F.lit(".csv")))
    )
    day = F.date_add(F.lit("2024-01-01").cast("date"), (doc % 366).cast("int")).cast("string")
    stamp = F.concat(day, F.lit("T10:"), F.lpad((doc % 60).cast("string"), 2, "0"), F.lit(":00.000Z"))
    return table(spark, sf_dir, "documents").select(
        doc.cast("string").alias("file_id"),
        name.alias("file_name"),
        F.when(doc % 17 != 0, stamp).otherwise("").alias("modified_at"),
        F.md5("text").alias("md5hash"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older control ledger: some files unknown, changed or failed."""
    listed = manifest(spark, sf_dir)
    n = F.col("file_id").cast("long")
    return listed.where(n % 5 != 0).select(
        "file_id", "file_name",
        F.when(n % 7 == 0, F.md5(F.lit("older"))).otherwise(F.col("md5hash")).alias("md5hash"),
        F.concat(F.lit("old/"), F.col("file_name")).alias("s3_key"),
        F.col("modified_at").alias("drive_modified_at"),
        F.when(n % 3 == 0, "FAILED").when(n % 11 == 0, "PENDING").otherwise("SUCCESS").alias("merge_status"),
    )


#: Rounds in which files are sent.
ROUNDS = 4


def send_files(rows: DataFrame, layout: Layout, folder: str, modified_ms: int) -> None:
    """Write the rows as feed files named by their column ``file_name``.

    Columns stand at their places in the layout, others are blank. Sending a
    name again replaces the file. All files get the modified time given. A file
    is one task's work, so whoever names them decides how large that is; rows
    are sorted by file before the blank columns make them wide.

    Files are sent in rounds, so that those replaced and those that replace
    them never lie on disk all at once.
    """
    own = [f.name for f in layout.fields if f.name in rows.columns]
    named = rows.select(*own, F.coalesce("file_name", F.lit("__HIVE_DEFAULT_PARTITION__")).alias("file_name"))
    with staged(named, "sent") as sent:
        for n in range(ROUNDS):
            _send(sent.where(F.pmod(F.xxhash64("file_name"), F.lit(ROUNDS)) == n), layout, folder, modified_ms)


def _send(rows: DataFrame, layout: Layout, folder: str, modified_ms: int) -> None:
    spark, beside = rows.sparkSession, f"{folder}.{uuid.uuid4().hex}"
    blank = F.lit(None).cast("string")
    texts = [(F.col(f.name).cast("string") if f.name in rows.columns else blank).alias(f.name) for f in layout.fields]
    dealt = rows.repartition("file_name").sortWithinPartitions("file_name")
    with passing_shuffles(spark):
        dealt.select(*texts, "file_name").write.partitionBy("file_name").options(
            header=True, escape='"', emptyValue="").csv(beside)
    fs, at = file_system(spark, folder)
    fs.mkdirs(at(folder))
    for named in fs.listStatus(at(beside)):
        name = named.getPath().getName().removeprefix("file_name=")
        if named.isDirectory():
            target = at(f"{folder}/{name}")
            fs.delete(target, False)
            parts = [f for f in fs.listStatus(named.getPath()) if f.getPath().getName().startswith("part-")]
            if len(parts) != 1 or not fs.rename(parts[0].getPath(), target):
                raise OSError(f"{name} was not written as one file")
            fs.setTimes(target, modified_ms, -1)
    fs.delete(at(beside), True)


#: Line items that one feed file of a provider group may stand for.
FILE_ROWS = 250_000


def files_per_group(spark: SparkSession, sf_dir: str) -> int:
    """Feed files of each of the four provider groups, so that files stay of one size as the table grows."""
    return -(-table(spark, sf_dir, "lineitem").count() // (4 * FILE_ROWS)) or 1


def staffing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All staffing rows, dealt by provider to four groups of feed files."""
    provider, many = F.col("provnum").cast("long"), files_per_group(spark, sf_dir)
    part = F.pmod(provider, F.lit(4)).cast("string")
    if many > 1:
        piece = F.pmod(F.xxhash64("provnum", "workdate"), F.lit(many)).cast("string")
        part = F.concat(part, F.lit("_"), piece)
    return staffing(spark, sf_dir).withColumn("file_name", F.concat(F.lit("PBJ_Daily_Nurse_Staffing_part"), part, F.lit(".csv")))


def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All snapshots with two-letter states, one feed file per month."""
    month = F.to_date(F.col("snapshot_date_key").cast("string"), "yyyyMMdd")
    short = snapshots(spark, sf_dir).withColumn("state", F.substring("state", 1, 2))
    return short.withColumn("file_name", F.concat(F.lit("NH_ProviderInfo_"), F.date_format(month, "MMMyyyy"), F.lit(".csv")))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One step status per event."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(e % 5 == 0, "FINISHED").when(e % 5 == 1, "ABORTED").when(e % 5 <= 3, "FAILED")
        .otherwise("STARTED").alias("status"),
        F.when(e % 3 == 0, F.concat(F.lit("DATA_ERROR | "), F.col("event_type")))
        .otherwise(F.concat(F.lit("timeout in "), F.col("event_type"))).alias("error"),
        (e % 2 + 1).cast("int").alias("attempt"),
    )


def error_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One error text per document: data errors of several wordings, and others."""
    language = F.col("lang")
    prefix = (
        F.when(language == "en", "Invalid digit: ").when(language == "de", "VALUE OUT OF RANGE ")
        .when(language == "fr", "violates not-null: ").otherwise("connection reset, ")
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(prefix, "text").alias("message"), "source")


def raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as feed text with values that do not fit their columns.

    A file holds the orders of one remainder, so misfits meet in few files.
    """
    order, file = F.col("l_orderkey"), F.col("l_orderkey") % 500
    late = F.col("l_linenumber") > 2
    text = [
        F.when(order % 50 != 0, F.col("l_suppkey").cast("string")).alias("provnum"),
        F.when(file == 7, "70000").otherwise((order % 30000).cast("string")).alias("county_fips"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus"),
                 F.when((order % 20 == 1) & late, "!").otherwise("")).alias("state"),
        F.when(file == 11, "123456.78").otherwise((F.col("l_extendedprice") % 90000).cast("decimal(7,2)").cast("string"))
        .alias("hrs_rn"),
        F.when((order % 25 == 3) & late, "n/a").otherwise(F.col("l_partkey").cast("string")).alias("workdate"),
        F.concat(F.lit("file_"), file.cast("string")).alias("file"),
    ]
    return table(spark, sf_dir, "lineitem").select(*text)


__all__ = [
    "error_texts", "files_per_group", "incoming", "jobs", "ledger", "manifest", "quality_snapshots", "raw_texts", "snapshots",
    "send_files", "snapshot_files", "staffing", "staffing_files", "staffing_raw", "stored", "table",
]
