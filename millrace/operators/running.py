"""Totals of any month range from running sums, without reading its days.

A facility has one row for each month from its first to the last of the table,
with all it has summed up until the month's end. The totals of a range are the
row of its last month less the row of the month before it, so a report reads
two months, however long the range is and however many days it holds.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.keys import div
from millrace.operators.metrics import SUM

#: Summed columns, and what their counts of known values are called.
_MEASURES = {"sum_census": "mdscensus", "sum_hours": "total_direct_care_hours", "sum_ctr_hours": "contract_direct_care_hours"}
_KNOWN = {name: f"known_{name.removeprefix('sum_')}" for name in _MEASURES}
_SUMS = ["reporting_days", *_MEASURES, *_KNOWN.values()]


def _ordinal(month: Column | str) -> Column:
    """YYYYMM -> months since year 0."""
    return div(month, 100) * 12 + F.pmod(F.col(month) if isinstance(month, str) else month, F.lit(100)) - 1


def _month(ordinal: Column) -> Column:
    return (div(ordinal, 12) * 100 + F.pmod(ordinal, F.lit(12)) + 1).cast("int")


def running_sums(facts: DataFrame) -> DataFrame:
    """``provnum, month_key`` and the sums up to the month's end.

    Days fold to months before the shuffle, so a facility is a group of as many
    rows as there are months. Days without a month belong to no range and are
    left out. A facility without a provnum is one like others. Unknown values
    add nothing; how many were known is summed beside them.

    Every month of a facility is a row of zeros beside what it has summed; rows
    of one month share its sums, and the zeros' row carries them on. So the
    months are filled by the sort of the running sums, without a hash table of
    all facilities and months.
    """
    dated = facts.where(F.col("month_key").isNotNull())
    monthly = dated.groupBy("provnum", "month_key").agg(
        F.count("*").alias("reporting_days"),
        F.sum("mdscensus").cast("bigint").alias("sum_census"),
        *[F.sum(_MEASURES[c]).cast(SUM).alias(c) for c in ("sum_hours", "sum_ctr_hours")],
        *[F.count(_MEASURES[c]).alias(known) for c, known in _KNOWN.items()],
    )
    last = dated.agg(F.max("month_key")).first()[0]
    spans = dated.groupBy("provnum").agg(F.min("month_key").alias("first"))
    every = spans.select(
        "provnum",
        F.explode(F.transform(F.sequence(_ordinal("first"), _ordinal(F.lit(last).cast("int"))), _month)).alias("month_key"),
        *[F.lit(0).cast(monthly.schema[c].dataType).alias(c) for c in _SUMS], F.lit(True).alias("_every"),
    )
    known = [F.coalesce(F.col(c), F.lit(0).cast(monthly.schema[c].dataType)).alias(c) for c in _SUMS]
    both = monthly.select("provnum", "month_key", *known, F.lit(False).alias("_every")).unionByName(every)
    until = Window.partitionBy("provnum").orderBy("month_key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return both.select(
        "provnum", "month_key", *[F.sum(c).over(until).cast(monthly.schema[c].dataType).alias(c) for c in _SUMS], "_every"
    ).where("_every").drop("_every")


def bounding_months(months: Iterable[int], start: int, end: int) -> tuple[int | None, int | None]:
    """Of the stored months the last before ``start`` and the last up to ``end``, None without one."""
    months = list(months)
    before, until = [m for m in months if m < start], [m for m in months if m <= end]
    return max(before, default=None), max(until, default=None)


def range_totals(sums: DataFrame, before: int | None, until: int | None) -> DataFrame:
    """``metrics.facility_totals`` of the days after month ``before`` up to the end of ``until``.

    Only the two months are read. Facilities without a day in the range are
    left out, and a sum of no known value is null.
    """
    sign = F.when(F.col("month_key") == F.lit(until), 1).otherwise(-1)
    edges = sums.where(F.col("month_key").isin([m for m in (before, until) if m is not None]))
    if before == until:
        edges = edges.limit(0)
    moved = edges.select("provnum", *[(F.col(c) * sign).alias(c) for c in _SUMS])
    totals = moved.groupBy("provnum").agg(*[F.sum(c).alias(c) for c in _SUMS]).where("reporting_days > 0")

    def known(name: str) -> Column:
        return F.when(F.col(_KNOWN[name]) > 0, F.col(name))

    return totals.select(
        "provnum", "reporting_days",
        F.try_divide(known("sum_census").cast("double"), F.col("known_census").cast("double")).alias("avg_census"),
        known("sum_census").alias("sum_census"),
        known("sum_hours").cast(SUM).alias("sum_hours"),
        known("sum_ctr_hours").cast(SUM).alias("sum_ctr_hours"),
    )
