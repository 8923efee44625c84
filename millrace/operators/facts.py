"""Fact tables and dimension lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import month_key
from millrace.functions.numbers import ratio, sum_of
from millrace.operators.history import UNKNOWN_KEY

HOURS = "decimal(9,2)"


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], key: str, default: int = UNKNOWN_KEY) -> DataFrame:
    """Adds the dimension's surrogate ``key``; a miss gets ``default``.

    ``dim`` holds one row per ``on``, so facts are never repeated.
    """
    found = dim.select(*on, key)
    return facts.join(found, on, "left").withColumn(key, F.coalesce(F.col(key), F.lit(default).cast("long")))


def staffing_measures(silver: DataFrame) -> DataFrame:
    """Day-grain measures: census, direct-care hours and contract hours.

    Absent hours count as zero, an absent census stays NULL.
    """
    return silver.dropna(subset=["provnum", "workdate"]).select(
        "provnum",
        F.col("workdate").alias("date_key"),
        month_key("workdate").alias("month_key"),
        "mdscensus",
        sum_of(["hrs_rn", "hrs_lpn", "hrs_cna"], HOURS).alias("total_direct_care_hours"),
        sum_of(["hrs_rn_ctr", "hrs_lpn_ctr", "hrs_cna_ctr"], HOURS).alias("contract_direct_care_hours"),
    )


def daily_fact(silver: DataFrame, dim: DataFrame) -> DataFrame:
    """Measures with the key of the provider's row for that month."""
    keyed = lookup(staffing_measures(silver), dim, ["provnum", "month_key"], "provider_key")
    return keyed.select(
        "provider_key", "provnum", "date_key", "month_key",
        "mdscensus", "total_direct_care_hours", "contract_direct_care_hours",
    )


# The ratings and counts the quality fact carries.
QUALITY_COLUMNS = [
    "overall_rating", "health_inspection_rating", "qm_rating", "longstay_qm_rating",
    "shortstay_qm_rating", "staffing_rating", "total_nurse_turnover_pct", "rn_turnover_pct",
    "administrators_left_count", "total_deficiencies_3yr", "facility_reported_incidents",
    "substantiated_complaints", "infection_control_citations", "num_fines", "total_fines_amount",
    "payment_denials", "total_penalties", "certified_beds", "avg_residents_per_day",
    "ownership_type", "special_focus_status", "abuse_icon",
]
CYCLES = [f"cycle{n}_total_health_deficiencies" for n in (1, 2, 3)]


def quality_fact(
    snapshots: DataFrame, columns: list[str] = QUALITY_COLUMNS, cycles: list[str] = CYCLES
) -> DataFrame:
    """Month-grain quality measures, a pruned projection without a shuffle."""
    total = sum_of(cycles, "int").cast("short").alias("total_deficiencies_3yr")
    return snapshots.select(
        "provnum",
        month_key("snapshot_date_key").alias("month_key"),
        *[total if c == "total_deficiencies_3yr" else F.col(c) for c in columns],
    )


def staffing_vs_quality(measures: DataFrame, quality: DataFrame, columns: list[str]) -> DataFrame:
    """Quality rows beside the month's staffing, on (provnum, month_key).

    Days are rolled up first, so the join meets one row per key on each side.
    """
    monthly = measures.groupBy("provnum", "month_key").agg(
        F.sum("mdscensus").alias("sum_census"),
        F.sum("total_direct_care_hours").cast("decimal(38,2)").alias("sum_hours"),
    )
    return monthly.join(quality.select("provnum", "month_key", *columns), ["provnum", "month_key"]).select(
        "provnum", "month_key", "sum_census", "sum_hours",
        ratio("sum_hours", "sum_census").alias("hprd"), *columns,
    )
