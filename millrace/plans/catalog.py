"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import keys as K
from millrace.functions import outcomes, text
from millrace.operators import (
    calendar, distribution, facts, history, ledger, metrics, profiling, quality, upsert,
)
from millrace.plans import gold, silver
from millrace.plans import standins as S
from millrace.plans.lake import Lake
from millrace.plans.report import Report
from millrace.session import scratch_path, written
from millrace.sources import drops, files, sinks, versions
from millrace.sources.layouts import SNAPSHOT_LAYOUT, STAFFING_LAYOUT, Field, Layout
from millrace.streaming import drops as streams

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
KEY = ["provnum", "workdate"]
ATTRIBUTES = [
    "provider_name", "provider_address", "state", "ownership_type", "provider_type", "certified_beds",
]
START, END = 199601, 199612

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Doubles summed in no fixed order agree between engines after rounding."""
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


# --- files and ingestion ---------------------------------------------------


@query
def classify_names(spark, sf_dir):
    named = ledger.classify(S.manifest(spark, sf_dir))
    return named.select(
        "file_id", "file_name", "file_type", F.col("name_error").isNotNull().alias("rejected")
    )


@query
def period_key(spark, sf_dir):
    listed = S.manifest(spark, sf_dir)
    return listed.select("file_id", text.snapshot_period("file_name").alias("snapshot_date_key"))


def _text_drop(spark, sf_dir):
    """Folder of text files, each with the texts of up to 50 documents."""
    drop = scratch_path(spark, "texts")
    docs = S.table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 50).alias("part"), "doc_id", "text")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda d: d["text"])
    docs.groupBy("part").agg(F.array_join(texts, "\n").alias("body")).write.partitionBy("part").text(drop)
    return drop


@query
def manifest_scan(spark, sf_dir):
    """The text files as a listing shows them."""
    listed = files.list_files(spark, _text_drop(spark, sf_dir), "*.txt")
    part = F.regexp_extract("path", "part=([0-9]+)", 1).cast("long")
    return listed.groupBy(part.alias("part")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query
def content_md5(spark, sf_dir):
    """Digest of every text file's bytes."""
    hashed = files.fingerprint_files(spark, _text_drop(spark, sf_dir), "*.txt")
    return hashed.select(F.regexp_extract("path", "part=([0-9]+)", 1).cast("long").alias("part"), "md5hash")


@query
def encodings(spark, sf_dir):
    """Sources written as UTF-8 or not, told apart by their bytes."""
    drop = scratch_path(spark, "encoded")
    docs = S.table(spark, sf_dir, "documents").select(
        "source", "doc_id", F.concat_ws(" ", F.translate("text", "\r\n", "  "), F.lit("é")).alias("line")
    )
    for n, charset in enumerate(("UTF-8", "ISO-8859-1")):
        half = docs.where(F.length("source") % 2 == n).hint("rebalance", "source")
        half.select("source", "line").write.mode("append").partitionBy("source").option("header", True).option(
            "encoding", charset
        ).csv(drop)
    checked = files.file_encodings(spark, drop)
    return checked.groupBy(F.regexp_extract("file_id", "source=([^/]+)", 1).alias("source")).agg(
        F.bool_and("is_utf8").alias("is_utf8")
    )


@query
def change_detect(spark, sf_dir):
    changes = ledger.detect_changes(S.manifest(spark, sf_dir), S.ledger(spark, sf_dir))
    return changes.select("file_id", "change")


@query
def landing_key(spark, sf_dir):
    listed = S.manifest(spark, sf_dir)
    return listed.select("file_id", text.landing_name("file_name", "modified_at").alias("s3_key"))


@query
def ledger_upsert(spark, sf_dir):
    known = S.ledger(spark, sf_dir)
    planned = ledger.plan_files(S.manifest(spark, sf_dir), known)
    return ledger.upsert_ledger(known, ledger.ledger_records(planned))


@query
def ledger_status(spark, sf_dir):
    results = S.manifest(spark, sf_dir).select(
        "file_id", F.when(F.length("file_name") % 2 == 0, "SUCCESS").otherwise("FAILED").alias("merge_status")
    )
    return ledger.set_status(S.ledger(spark, sf_dir), results)


@query
def run_summary(spark, sf_dir):
    return ledger.run_summary(ledger.plan_files(S.manifest(spark, sf_dir), S.ledger(spark, sf_dir)))


FEED = Layout(
    (
        Field("provnum", "varchar(20)"), Field("workdate", "int"), Field("mdscensus", "smallint"),
        Field("hrs_rn", "decimal(5,2)"), Field("hrs_lpn", "decimal(7,2)"), Field("hrs_cna", "decimal(6,2)"),
        Field("l_orderkey", "bigint"), Field("l_linenumber", "int"), Field("seen", "date"), Field("note", "varchar(40)"),
    ),
    ("provnum", "workdate"),
)


@query
def typed_load(spark, sf_dir):
    """Table -> CSV drop -> positional typed load; headers are ignored.

    The text has surplus decimals and quoted line breaks; the files of one
    folder in twenty hold dates that are none.
    """
    drop = scratch_path(spark, "drop")
    order = F.col("l_orderkey")
    rows = S.staffing_raw(spark, sf_dir).select(
        *[
            F.concat(F.col(c).cast("string"), F.when(order % 10 == 4, "9").otherwise("")).alias(c) if c == "hrs_lpn" else c
            for c in FEED.names[:8]
        ],
        F.when(order % 20 == 3, "2024-5").otherwise("2024-05-01").alias("seen"),
        F.when(order % 10 < 5, F.concat(F.lit("first line\nof order "), order.cast("string"))).otherwise("plain").alias("note"),
        (order % 20).alias("part"),
    )
    named = rows.toDF(*[f"column {i}" for i in range(len(FEED.names))], "part")
    named.hint("rebalance", "part").write.partitionBy("part").options(header=True, escape='"').csv(drop)
    raw = drops.read_feed(spark, drop, FEED)
    checked = written(quality.check_types(raw, FEED.fields, FEED.key, drops.MALFORMED), "parsed")
    whole = quality.without_files(checked, quality.bad_files(checked, drops.SOURCE_FILE), drops.SOURCE_FILE)
    return quality.apply_types(whole.select(FEED.names), FEED.fields)


@query
def blank_as_null(spark, sf_dir):
    docs = S.table(spark, sf_dir, "documents")
    spaced = docs.select(
        "doc_id",
        F.when(F.col("n_chars") % 3 == 0, "   ").when(F.col("n_chars") % 3 == 1, "")
        .otherwise(F.col("lang")).alias("lang"),
        F.concat(F.lit(" "), "source").alias("source"),
    )
    return text.blanks_to_null(spaced)


@query
def undecodable_text(spark, sf_dir):
    """Texts written in another encoding, as the feed reader takes them."""
    drop = scratch_path(spark, "latin")
    docs = S.table(spark, sf_dir, "documents")
    docs.select("doc_id", F.translate("text", "\r\n\"", "   ").alias("text")).write.options(
        header=True, encoding="ISO-8859-1", escape='"'
    ).csv(drop)
    layout = Layout((Field("doc_id", "bigint"), Field("text", "varchar(65535)")), ("doc_id",))
    read = drops.read_positional(spark, drop, layout)
    return read.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("md5hash"))


@query
def reject_files(spark, sf_dir):
    rows = S.raw_texts(spark, sf_dir)
    checked = quality.check_types(rows, RAW_FIELDS, ["provnum"])
    bad = written(quality.bad_files(checked, "file"), "bad")
    whole = quality.without_files(rows, bad, "file")
    return whole.groupBy("file").agg(F.count("*").alias("rows_loaded"))


@query
def table_names(spark, sf_dir):
    pages = S.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.table_name("url").alias("table_name"))


@query
def name_collisions(spark, sf_dir):
    pages = S.table(spark, sf_dir, "pages").select("page_id", F.concat("url", F.lit(".csv")).alias("path"))
    return drops.file_tables(pages).select("page_id", "path", "table_name", "first_path", "outcome")


@query
def lineage(spark, sf_dir):
    """Rows stamped from their file's manifest entry."""
    raw = S.staffing_raw(spark, sf_dir).withColumn("month", K.month_key("workdate"))
    entry = F.concat(F.lit("staffing_"), F.col("month").cast("string"), F.lit(".csv"))
    manifest = raw.select("month").distinct().select(
        "month", entry.alias("_source_s3_key"),
        F.concat(F.col("month").cast("string"), F.lit("-01")).alias("_drive_modified_at"),
        F.md5(entry).alias("_md5hash"),
    )
    rows = silver.with_lineage(raw, manifest, "month", ["provnum", "workdate", "l_orderkey", "l_linenumber"])
    return rows.drop("_loaded_at")


# --- data quality ----------------------------------------------------------

RAW_FIELDS = [
    Field("provnum", "varchar(20)"), Field("county_fips", "smallint"), Field("state", "varchar(2)"),
    Field("hrs_rn", "decimal(7,2)"), Field("workdate", "int"),
]


@query
def dup_keys(spark, sf_dir):
    return quality.duplicate_keys(S.staffing_raw(spark, sf_dir), KEY)


@query
def drop_null_keys(spark, sf_dir):
    kept = quality.drop_null_keys(S.raw_texts(spark, sf_dir), ["provnum"])
    return kept.select("provnum", "county_fips", "workdate", "file")


@query
def type_violations(spark, sf_dir):
    return quality.violation_counts(
        quality.check_types(S.raw_texts(spark, sf_dir), RAW_FIELDS, ["provnum"])
    )


@query
def dedup_latest(spark, sf_dir):
    return S.staffing(spark, sf_dir)


@query
def error_class(spark, sf_dir):
    errors = S.error_texts(spark, sf_dir)
    return errors.select("doc_id", outcomes.error_class("message").alias("error_class"))


@query
def error_message(spark, sf_dir):
    errors = S.error_texts(spark, sf_dir)
    return errors.select("doc_id", F.md5(outcomes.tagged_error("message", "source")).alias("message_md5"))


@query
def route_outcome(spark, sf_dir):
    jobs = S.jobs(spark, sf_dir)
    return jobs.select("event_id", outcomes.route("status", "error", "attempt").alias("action"))


@query
def quarantine_counts(spark, sf_dir):
    unnamed = ledger.classify(S.manifest(spark, sf_dir)).where("name_error IS NOT NULL")
    checked = quality.check_types(S.raw_texts(spark, sf_dir), RAW_FIELDS, ["provnum"])
    broken = quality.bad_files(checked, "file")
    repeated = quality.duplicate_keys(S.staffing_raw(spark, sf_dir), KEY)
    failed = S.jobs(spark, sf_dir).where(outcomes.route("status", "error", "attempt") == "REJECT")
    return quality.reject_counts([
        quality.reject(unnamed, outcomes.UNKNOWN_FILE_TYPE, "file_name"),
        quality.reject(broken, outcomes.COPY_FAILED, "file"),
        quality.reject(repeated, outcomes.DUPLICATE_KEY, F.col("provnum")),
        quality.reject(failed, outcomes.MERGE_FAILED, F.col("event_id").cast("string")),
    ])


# --- silver writes ---------------------------------------------------------


@query
def merge_candidates(spark, sf_dir):
    return upsert.merge_candidates(
        S.stored(spark, sf_dir), S.incoming(spark, sf_dir), KEY, "stamp", "md5hash"
    )


@query
def lww_upsert(spark, sf_dir):
    target = S.stored(spark, sf_dir).withColumn("hrs_rn", F.col("hrs_rn").cast("decimal(6,2)"))
    return upsert.upsert_latest(target, S.incoming(spark, sf_dir), KEY, "stamp", "md5hash")


@query
def snapshot_replace(spark, sf_dir):
    """Half the providers re-sent, some months only, with more beds."""
    stored = S.snapshots(spark, sf_dir)
    n, month = F.col("provnum").cast("long"), K.month_key("snapshot_date_key")
    resent = stored.where((n % 2 == 0) & (month % 100 <= 6)).withColumn(
        "certified_beds", (F.coalesce("certified_beds", F.lit(0)) + 1).cast("smallint")
    )
    return upsert.replace_snapshots(
        stored, resent, ["provnum"], "snapshot_date_key", [F.col("provider_name").desc()]
    )


# --- gold ------------------------------------------------------------------


@query
def date_spine(spark, sf_dir):
    """Every day between the first and last order."""
    return calendar.days_of(S.table(spark, sf_dir, "orders"), F.to_date("o_orderdate"))


@query
def dim_date(spark, sf_dir):
    return calendar.calendar_columns(date_spine(spark, sf_dir))


@query
def change_flags(spark, sf_dir):
    flagged = history.change_flags(S.snapshots(spark, sf_dir), "provnum", "snapshot_date_key", ATTRIBUTES)
    return flagged.select("provnum", "snapshot_date_key", "changed")


@query
def scd2(spark, sf_dir):
    return _dim(spark, sf_dir)


@query
def scd2_global(spark, sf_dir):
    """Versions current only if they reach the latest month of all."""
    return history.version_history(
        S.snapshots(spark, sf_dir), "provnum", "snapshot_date_key", ATTRIBUTES, as_of="global"
    ).select("provnum", "month_key", "effective_from", "effective_to", "is_current")


def _dim(spark, sf_dir):
    return history.dimension(S.snapshots(spark, sf_dir), "provnum", "snapshot_date_key", ATTRIBUTES)


@query
def surrogate_key(spark, sf_dir):
    months = S.snapshots(spark, sf_dir).select("provnum", K.month_key("snapshot_date_key").alias("month_key"))
    return months.withColumn("provider_key", K.surrogate_key("provnum", "month_key"))


@query
def dim_with_unknown(spark, sf_dir):
    return history.with_unknown(_dim(spark, sf_dir))


@query
def dim_lookup(spark, sf_dir):
    found = facts.lookup(_measures(spark, sf_dir), _keys(spark, sf_dir), ["provnum", "month_key"], "provider_key")
    return found.select("provnum", "date_key", "provider_key")


def _keys(spark, sf_dir):
    """The dimension's key columns; a lookup needs no version bounds."""
    return surrogate_key(spark, sf_dir)


def _measures(spark, sf_dir):
    return facts.staffing_measures(S.staffing(spark, sf_dir))


@query
def fact_daily(spark, sf_dir):
    return facts.daily_fact(S.staffing(spark, sf_dir), _keys(spark, sf_dir))


QUALITY = ["overall_rating", "total_deficiencies_3yr", "certified_beds", "ownership_type"]


def _quality(spark, sf_dir):
    return facts.quality_fact(S.quality_snapshots(spark, sf_dir), QUALITY)


@query
def fact_quality(spark, sf_dir):
    return _quality(spark, sf_dir)


@query
def staffing_vs_quality(spark, sf_dir):
    return facts.staffing_vs_quality(
        _measures(spark, sf_dir), _quality(spark, sf_dir), ["overall_rating", "total_deficiencies_3yr"]
    )


@query
def calendar_join(spark, sf_dir):
    """Days fold to one row each before they meet the calendar."""
    daily = _measures(spark, sf_dir).groupBy("date_key").agg(
        F.count("*").alias("days"), F.sum("mdscensus").alias("sum_census")
    )
    joined = calendar.join_calendar(daily, calendar.calendar_of(daily))
    return joined.groupBy("year", "day_name", "is_weekend").agg(
        F.sum("days").alias("days"), F.sum("sum_census").alias("sum_census")
    )


@query
def month_calendar_join(spark, sf_dir):
    months = calendar.at_month_start(_quality(spark, sf_dir))
    joined = calendar.join_calendar(months, calendar.calendar_of(months))
    return joined.select("provnum", "month_key", "overall_rating", "full_date", "quarter_name", "year")


# --- reports ---------------------------------------------------------------


def _attributes(spark, sf_dir):
    dim = S.snapshots(spark, sf_dir).withColumn("month_key", K.month_key("snapshot_date_key"))
    return history.latest_attributes(dim, "provnum", [a for a in metrics.ATTRIBUTES if a in dim.columns])


def _range(spark, sf_dir):
    return metrics.in_months(_measures(spark, sf_dir), START, END)


def _facilities(spark, sf_dir):
    return metrics.facility_metrics(_measures(spark, sf_dir), _attributes(spark, sf_dir))


def _filtered(spark, sf_dir, **choice):
    return metrics.filter_facilities(_facilities(spark, sf_dir), **choice)


def _report(spark, sf_dir):
    """The filtered report frame, stored for operators that read it repeatedly."""
    return written(_filtered(spark, sf_dir), "report")


@query
def month_bounds(spark, sf_dir):
    return metrics.month_bounds(_measures(spark, sf_dir))


@query
def month_list(spark, sf_dir):
    return metrics.month_list(metrics.month_bounds(_measures(spark, sf_dir)))


@query
def latest_attrs(spark, sf_dir):
    return _attributes(spark, sf_dir)


@query
def range_filter(spark, sf_dir):
    return _range(spark, sf_dir)


@query
def facility_agg(spark, sf_dir):
    return metrics.facility_totals(_range(spark, sf_dir))


@query
def facility_metrics(spark, sf_dir):
    return metrics.facility_metrics(_range(spark, sf_dir), _attributes(spark, sf_dir))


@query
def monthly_trend(spark, sf_dir):
    return metrics.monthly_trend(_range(spark, sf_dir), _attributes(spark, sf_dir))


@query
def filter_options(spark, sf_dir):
    return metrics.filter_options(_facilities(spark, sf_dir), ["state", "ownership_type", "provider_type"])


@query
def facility_filter(spark, sf_dir):
    return _filtered(
        spark, sf_dir, states=[f"NATION_{n}" for n in range(0, 25, 2)], ownerships=["N", "R"], min_days=40
    )


@query
def kpis(spark, sf_dir):
    row = metrics.headline(_filtered(spark, sf_dir))
    return rounded(row, "avg_hprd", "avg_mix", "avg_reliance", "below_target_pct")


@query
def hist_hprd(spark, sf_dir):
    return rounded(distribution.histogram(_report(spark, sf_dir), "hprd"), "bin_low")


@query
def hist_reliance(spark, sf_dir):
    shown = distribution.clipped(_report(spark, sf_dir), "contract_reliance", "reliance_disp")
    return rounded(distribution.histogram(shown, "reliance_disp"), "bin_low")


@query
def scatter_mix(spark, sf_dir):
    hover = ["avg_census", "ownership_type", "provider_name", "state"]
    return distribution.scatter(_filtered(spark, sf_dir), "hprd", "contract_mix", hover)


@query
def scatter_reliance(spark, sf_dir):
    shown = distribution.clipped(_report(spark, sf_dir), "contract_reliance", "reliance_disp")
    hover = ["avg_census", "ownership_type", "provider_name", "state", "contract_reliance"]
    return rounded(
        distribution.scatter(shown, "reliance_disp", "contract_mix", hover), "reliance_disp"
    )


@query
def by_state(spark, sf_dir):
    return rounded(metrics.by_state(_filtered(spark, sf_dir)), "census", "hprd", "contract_mix")


# The columns of the ranked lists.
RANKED = [
    "provnum", "provider_name", "state", "ownership_type", "certified_beds", "avg_census", "hprd",
    "contract_mix", "contract_reliance", "reporting_days",
]


@query
def low_hprd(spark, sf_dir):
    top = distribution.ranking(_filtered(spark, sf_dir), "hprd", largest=False)
    return distribution.labelled(top, RANKED)


@query
def high_mix(spark, sf_dir):
    top = distribution.ranking(_filtered(spark, sf_dir), "contract_mix", largest=True)
    return distribution.labelled(top, RANKED)


@query
def high_reliance(spark, sf_dir):
    top = distribution.ranking(_filtered(spark, sf_dir), "contract_reliance", largest=True)
    return distribution.labelled(top, RANKED)


@query
def system_trend(spark, sf_dir):
    return metrics.system_trend(metrics.monthly_trend(_measures(spark, sf_dir), _attributes(spark, sf_dir)))


@query
def thresholds(spark, sf_dir):
    return rounded(distribution.thresholds(_report(spark, sf_dir)), "hprd_p10", "mix_p90")


# The columns of the outlier list.
FLAGGED = [
    "Flag label", "provnum", "provider_name", "state", "ownership_type", "hprd", "contract_mix",
    "contract_reliance", "avg_census",
]


@query
def outliers(spark, sf_dir):
    flagged = distribution.flag_outliers(_report(spark, sf_dir))
    return distribution.labelled(flagged, FLAGGED, {**distribution.LABELS, "Flag label": "Flag"})


# --- exploration -----------------------------------------------------------


def _tables(spark, sf_dir):
    return {name: S.table(spark, sf_dir, name) for name in TABLES}


@query
def table_inventory(spark, sf_dir):
    return profiling.table_inventory(_tables(spark, sf_dir))


@query
def column_dictionary(spark, sf_dir):
    return profiling.column_dictionary(_tables(spark, sf_dir))


@query
def sample_rows(spark, sf_dir):
    return profiling.sample_rows(S.table(spark, sf_dir, "orders"), ["o_orderkey"])


@query
def column_profile(spark, sf_dir):
    return profiling.column_profile(S.staffing_raw(spark, sf_dir))


@query
def full_dups(spark, sf_dir):
    """Line items of which the first of each order was sent twice."""
    line = S.table(spark, sf_dir, "lineitem")
    return profiling.full_duplicates(line.unionByName(line.where("l_linenumber = 1")))


@query
def key_multiplicity(spark, sf_dir):
    return profiling.key_multiplicity(S.staffing_raw(spark, sf_dir), ["provnum"])


@query
def day_span(spark, sf_dir):
    return profiling.day_span(S.staffing_raw(spark, sf_dir), "workdate")


@query
def grain_test(spark, sf_dir):
    return profiling.grain_test(
        S.staffing(spark, sf_dir), [["provnum"], ["workdate"], ["provnum", "workdate"]]
    )


# --- incremental -----------------------------------------------------------


@query
def incremental_upsert(spark, sf_dir):
    """Incoming rows arriving as files, merged batch by batch into stored ones."""
    arrivals, table = scratch_path(spark, "arrivals"), scratch_path(spark, "silver")
    target = S.stored(spark, sf_dir).withColumn("hrs_rn", F.col("hrs_rn").cast("decimal(6,2)"))
    month = K.month_key("workdate").alias("month_key")
    sinks.write_partitions(target.select("*", month), table, "month_key")
    S.incoming(spark, sf_dir).select("*", month).write.parquet(arrivals)
    landed = spark.read.parquet(arrivals)
    per_batch = -(-len(landed.inputFiles()) // 3)
    stream = (
        spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", per_batch).parquet(arrivals)
    )
    streams.merge_stream(
        stream, table, KEY, "month_key", "stamp", "md5hash", scratch_path(spark, "offsets")
    )
    return spark.read.schema(landed.schema).parquet(table)


# --- stored tables ---------------------------------------------------------


@query
def full_refresh(spark, sf_dir):
    """A table refreshed from itself, by partition; the second write replaces the first."""
    path = scratch_path(spark, "refreshed")
    sinks.replace_table(S.snapshots(spark, sf_dir), path, "snapshot_date_key", "provnum")
    stored = spark.read.parquet(path)
    more = (F.coalesce("certified_beds", F.lit(0)) + 1).cast("smallint")
    sinks.replace_table(stored.withColumn("certified_beds", more), path, "snapshot_date_key", "provnum")
    schema = ", ".join(f"{c} {t}" for c, t in stored.dtypes)
    return sinks.read_table(spark, path, schema)


@query
def interrupted_refresh(spark, sf_dir):
    """A refresh that stopped between its renames loses nothing."""
    path = scratch_path(spark, "stopped")
    sinks.replace_table(S.manifest(spark, sf_dir), f"{path}.previous")
    return sinks.read_table(spark, path, "file_id string, file_name string, modified_at string, md5hash string")


@query
def versioned_table(spark, sf_dir):
    """A table replaced whole, then some of its partitions from itself, then added to."""
    table = versions.VersionedTable(spark, scratch_path(spark, "versioned"), "snapshot_date_key")
    early = F.col("snapshot_date_key") % 10000 <= 601
    snapshots = S.snapshots(spark, sf_dir)
    table.replace(snapshots.where("provnum <> '1'"), "provnum")
    more = (F.coalesce("certified_beds", F.lit(0)) + 1).cast("smallint")
    table.republish(table.read().where(early).withColumn("certified_beds", more), "provnum")
    table.append(snapshots.where("provnum = '1'"), "provnum")
    return table.read()


# When the files of the stand-in drops were modified.
SENT, SENT_AGAIN = 1_717_200_000_000, 1_717_300_000_000
DIMENSION = ["provider_key", "provnum", "month_key", "effective_from", "effective_to", "is_current", *ATTRIBUTES]


@query
def changed_files(spark, sf_dir):
    """A stream over a drop in which files are sent again: two groups with other rows, one mended.

    The second run takes three groups of files, then the fourth.
    """
    lake, drop, checkpoint = Lake(spark, scratch_path(spark, "lake")), scratch_path(spark, "drop"), scratch_path(spark, "offsets")
    rows, part = S.staffing_files(spark, sf_dir), F.pmod(F.col("provnum").cast("long"), F.lit(4))
    first = rows.where((part < 2) | (part == 3)).withColumns({
        "hrs_rn": F.when(part < 2, F.col("hrs_rn") + 1).otherwise(F.col("hrs_rn")).cast("string"),
        "state": F.when(part == 3, "too long"),
    })
    S.send_files(first, STAFFING_LAYOUT, drop, SENT)
    streams.ingest_new_files(lake, drop, checkpoint, gold=False)
    S.send_files(rows, STAFFING_LAYOUT, drop, SENT_AGAIN)
    streams.ingest_new_files(lake, drop, checkpoint, files_per_batch=3 * S.files_per_group(spark, sf_dir), gold=False)
    return lake.staffing.select("provnum", "workdate", "mdscensus", "hrs_rn", "hrs_lpn", "hrs_cna")


@query
def gold_refresh(spark, sf_dir):
    """A drop to silver to gold; in a first refresh the dimension can't be written."""
    lake, drop = Lake(spark, scratch_path(spark, "lake")), scratch_path(spark, "drop")
    S.send_files(S.staffing_files(spark, sf_dir), STAFFING_LAYOUT, drop, SENT)
    S.send_files(S.snapshot_files(spark, sf_dir), SNAPSHOT_LAYOUT, drop, SENT)
    silver.ingest(lake, files.fingerprint_files(spark, drop))
    fs, at = sinks.file_system(spark, lake.path(gold.PROVIDERS))
    fs.create(at(lake.path(gold.PROVIDERS)), True).close()  # a file where the folder should be
    stopped = gold.refresh_gold(lake)
    fs.delete(at(lake.path(gold.PROVIDERS)), False)
    done = gold.refresh_gold(lake)
    refused = lake.rejects.where("error_type = 'DIM_PROVIDER_REFRESH_FAILED'").count()
    return lake.table(gold.DAILY).drop("_refreshed_at").withColumns({
        "first_dimension": F.lit(stopped["dim_provider"]), "first_fact": F.lit(stopped["fact_daily_staffing"]),
        "then_fact": F.lit(done["fact_daily_staffing"]), "dimension_rejects": F.lit(refused).cast("long"),
    })


@query
def touched_dimension(spark, sf_dir):
    """Snapshots arriving in two waves as a stream; the second rebuilds only the providers it names."""
    lake, drop, checkpoint = Lake(spark, scratch_path(spark, "lake")), scratch_path(spark, "drop"), scratch_path(spark, "offsets")
    rows = S.snapshot_files(spark, sf_dir)
    recent = F.col("snapshot_date_key") >= 19980000
    S.send_files(rows.where(~recent), SNAPSHOT_LAYOUT, drop, SENT)
    streams.ingest_new_files(lake, drop, checkpoint)
    S.send_files(rows.where(recent), SNAPSHOT_LAYOUT, drop, SENT_AGAIN)
    streams.ingest_new_files(lake, drop, checkpoint)
    return lake.table(gold.PROVIDERS).select(DIMENSION)


@query
def inferred_load(spark, sf_dir):
    """Tables written as one CSV folder each, loaded with inferred types and profiled."""
    out = None
    for name in ("supplier", "orders", "part"):
        drop = scratch_path(spark, name)
        S.table(spark, sf_dir, name).write.options(header=True, escape='"').csv(drop)
        loaded = drops.read_inferred(spark, drop)
        rows = profiling.column_profile(loaded).select(F.lit(name).alias("table_name"), "column_name", "total_rows", "non_null", "distinct_values")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def replayed_merge(spark, sf_dir):
    """The same incoming rows merged twice change nothing the second time."""
    table = scratch_path(spark, "silver")
    month = K.month_key("workdate").alias("month_key")
    target = S.stored(spark, sf_dir).withColumn("hrs_rn", F.col("hrs_rn").cast("decimal(6,2)"))
    sinks.write_partitions(target.select("*", month), table, "month_key")
    schema = spark.read.parquet(table).schema
    incoming = written(S.incoming(spark, sf_dir).select("*", month), "incoming")
    for _ in range(2):
        silver.merge_rows(incoming, table, KEY, "month_key", "stamp", "md5hash")
    return spark.read.schema(schema).parquet(table)


@query
def range_from_sums(spark, sf_dir):
    """The facilities of a month range from two months of the fact's running sums."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.stored(gold.DAILY, "month_key").replace(_measures(spark, sf_dir), "provnum")
    gold.refresh_sums(lake)
    totals = gold.range_totals(lake, lake.stored(gold.DAILY).newest(), START, END)
    return metrics.facility_ratios(totals, _attributes(spark, sf_dir))


@query
def stored_report(spark, sf_dir):
    """A second report of a month range reads what the first one stored in the lake."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.stored(gold.DAILY, "month_key").replace(_measures(spark, sf_dir), "provnum")
    dim = S.snapshots(spark, sf_dir).withColumn("month_key", K.month_key("snapshot_date_key"))
    blank = {c: F.lit(None).cast("string") for c in metrics.ATTRIBUTES if c not in dim.columns}
    lake.stored(gold.PROVIDERS).replace(dim.withColumns(blank), "provnum")
    with Report(lake, START, END) as first:
        first.all_facilities.count()
    with Report(lake, START, END) as second:
        if any(gold.DAILY in f for f in second.all_facilities.inputFiles()):
            raise AssertionError("the stored result was not read")
        return second.all_facilities.drop(*blank)


@query
def report_reuse(spark, sf_dir):
    """One stored report frame read for its thresholds, its headline and its states."""
    report = _report(spark, sf_dir)
    parts = [
        distribution.thresholds(report).select("hprd_p10", "mix_p90"),
        metrics.headline(report).select("facilities"),
        metrics.by_state(report).agg(F.count("*").alias("state_rows")),
    ]
    rows = [
        part.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in part.columns
        ])).alias("row")).select("row.*")
        for part in parts
    ]
    return rounded(rows[0].unionByName(rows[1]).unionByName(rows[2]), "value")
