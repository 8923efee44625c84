"""Integer calendar keys (YYYYMMDD, YYYYMM) and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a: Column | str, n: int) -> Column:
    """Integer division: ``/`` gives a double in Spark, ``div`` a long."""
    return F.call_function("div", col(a).cast("long"), F.lit(n).cast("long")).cast("int")


def month_key(day_key: Column | str) -> Column:
    """YYYYMMDD -> YYYYMM."""
    return div(day_key, 100)


def first_day_key(month: Column | str) -> Column:
    """YYYYMM -> YYYYMM01, the key a month table joins the calendar on."""
    return (col(month) * 100 + 1).cast("int")


def day_key_of(date: Column | str) -> Column:
    """DATE or TIMESTAMP -> YYYYMMDD."""
    d = col(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_of(day_key: Column | str) -> Column:
    """YYYYMMDD -> DATE; NULL when the digits are no calendar date."""
    text = col(day_key).cast("string")
    iso = F.concat_ws("-", F.substr(text, F.lit(1), F.lit(4)),
                      F.substr(text, F.lit(5), F.lit(2)), F.substr(text, F.lit(7), F.lit(2)))
    return F.when(F.length(text) == 8, iso.try_cast("date"))


def is_month_key(month: Column | str) -> Column:
    return F.pmod(col(month), F.lit(100)).between(1, 12)


def month_label(month: Column | str) -> Column:
    """202406 -> ``2024-06``."""
    m = col(month)
    return F.format_string("%d-%02d", div(m, 100), F.pmod(m, F.lit(100)))


def surrogate_key(*parts: Column | str) -> Column:
    """Deterministic 60-bit key over ``_``-joined parts; never negative.

    MD5-based so that any SQL engine can recompute it. NULL if a part is NULL.
    """
    joined = col(parts[0]).cast("string")
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("_"), col(part).cast("string"))
    return F.conv(F.substr(F.md5(joined), F.lit(1), F.lit(15)), 16, 10).cast("long")
