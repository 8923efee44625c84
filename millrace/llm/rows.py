"""Helpers shared by the operators: words, ranks without a single task, row pairing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import written

#: The six white-space characters of the contracts: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def without_blanks(column: str = "text") -> Column:
    """The text after deleting every white-space character; null counts as empty."""
    return F.translate(text_or_empty(column), BLANKS, "")


def word_count(column: str = "text") -> Column:
    """Words of the text; null has none."""
    return F.size(F.regexp_extract_all(text_or_empty(column), F.lit(WORD), 0)).cast("long")


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of the named columns of both frames."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` plus the row's position (from 0) within ``keys`` in ``order``.

    Rows are range-partitioned by keys and order, so a key that holds a third
    of the rows is cut into many ranges; positions are counted inside a range
    and shifted by the rows of earlier ranges. A window only ever holds one
    range, or one row per range. ``df`` should be narrow: it is written once.
    Rows that are equal in ``order`` may swap their positions between runs.
    """
    by = [F.col(k).asc_nulls_last() for k in keys]
    placed = written(
        df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    place = ["_range", *keys]
    counts = placed.groupBy(*place).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*place, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*place).orderBy(*order)
    local = placed.withColumn("_inside", F.row_number().over(inside))
    return (
        local.join(shifts, same(local, shifts, place))
        .select(*[local[c] for c in df.columns], (F.col("_inside") - 1 + F.col("_shift")).alias(name))
    )


def attach(docs: DataFrame, decisions: DataFrame, keys: dict[str, Column], order: Sequence[str]) -> DataFrame:
    """``docs`` with the other columns of ``decisions``, row paired with row.

    ``keys`` maps key columns of ``decisions`` to expressions over ``docs``;
    both frames hold each key equally often. Only rows whose key repeats need a
    number of their own: those of ``decisions`` are numbered by ``order``,
    those of ``docs`` by all columns. Names in ``decisions`` must not clash
    with those of ``docs``.
    """
    names = list(keys)
    decisions = written(decisions, "decisions")
    keyed = docs.withColumns(keys)
    values = [c for c in decisions.columns if c not in names]
    repeated = decisions.groupBy(*names).count().filter("count > 1").drop("count")
    if repeated.isEmpty():
        return _paired(keyed, decisions, names, docs.columns, values)
    repeated = written(repeated, "repeated")
    sides = []
    for frame, by in ((keyed, docs.columns), (decisions, order)):
        once = frame.join(repeated, same(frame, repeated, names), "left_anti").withColumn("__nth", F.lit(1))
        often = frame.join(repeated, same(frame, repeated, names), "left_semi")
        often = often.withColumn("__nth", F.row_number().over(Window.partitionBy(*names).orderBy(*by)))
        sides.append(once.unionByName(often))
    return _paired(*sides, [*names, "__nth"], docs.columns, values)


def _paired(left: DataFrame, right: DataFrame, names: Sequence[str], own: list[str], values: list[str]) -> DataFrame:
    return left.join(right, same(left, right, names)).select(
        *[left[c] for c in own], *[right[c] for c in values]
    )
