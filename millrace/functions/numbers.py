"""Guarded ratios and NULL-tolerant sums."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.keys import col


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double; NULL unless the denominator is positive.

    Cast before dividing: decimal division would widen to decimal(38, s), and
    ANSI mode raises on a zero denominator.
    """
    return F.when(col(den) > 0, col(num).cast("double") / col(den).cast("double"))


def sum_of(columns: list[str], dtype: str) -> Column:
    """Row-wise sum with NULL as zero, kept at the columns' own precision.

    A typed zero keeps decimal(p, s) from widening the way an integer 0 does.
    """
    zero = F.lit(0).cast(dtype)
    return reduce(add, [F.coalesce(F.col(c).cast(dtype), zero) for c in columns]).cast(dtype)


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    """sum(value * weight) / sum(weight).

    Rows with a NULL value drop out of the numerator only, rows with a NULL
    weight out of both.
    """
    return F.try_divide(F.sum(col(value) * col(weight)), F.sum(col(weight)))
