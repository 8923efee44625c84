"""Calendar dimension and joins to it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.keys import day_key_of, first_day_key, month_key

def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive (ISO dates)."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return spark.range(max((last - first).days + 1, 0)).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date")
    )


def days_of(rows: DataFrame, date: Column) -> DataFrame:
    """One row per day from the first to the last ``date`` of ``rows``."""
    bounds = rows.agg(F.min(date).alias("first"), F.max(date).alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last")).alias("full_date"))


def calendar_columns(days: DataFrame, date: str = "full_date") -> DataFrame:
    """Calendar attributes for a column of distinct dates; Sunday is day 0."""
    d = F.col(date)
    weekday = F.dayofweek(d) - 1
    year = F.year(d)
    return days.select(
        day_key_of(d).alias("date_key"),
        d.alias("full_date"),
        month_key(day_key_of(d)).alias("month_key"),
        F.dayofmonth(d).cast("short").alias("day_of_month"),
        weekday.cast("short").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.weekofyear(d).cast("short").alias("week_of_year"),
        F.month(d).cast("short").alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("short").alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        year.cast("short").alias("year"),
        ((year % 400 == 0) | ((year % 4 == 0) & (year % 100 != 0))).alias("is_leap_year"),
    )


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    return calendar_columns(date_spine(spark, start, end))


def join_calendar(facts: DataFrame, calendar: DataFrame, date_key: str = "date_key") -> DataFrame:
    """Day-grain facts with calendar columns, one row per fact.

    A fact whose day the calendar lacks stays, with NULL calendar columns.
    """
    extra = [c for c in calendar.columns if c not in facts.columns or c == date_key]
    return facts.join(calendar.select(extra), date_key, "left")


def calendar_of(facts: DataFrame, date_key: str = "date_key") -> DataFrame:
    """The calendar from the first to the last day of ``facts``."""
    return calendar_columns(days_of(facts, F.to_date(F.col(date_key).cast("string"), "yyyyMMdd")))


def join_month_calendar(facts: DataFrame, calendar: DataFrame, month: str = "month_key") -> DataFrame:
    """Month-grain facts with the calendar row of the month's first day.

    Joining on the month key would repeat each fact once per day.
    """
    return join_calendar(at_month_start(facts, month), calendar)


def at_month_start(facts: DataFrame, month: str = "month_key") -> DataFrame:
    """Month-grain facts with the key of their month's first day."""
    return facts.withColumn("date_key", first_day_key(month))
