"""Slowly changing dimension rebuilt from full monthly history."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.keys import month_key, surrogate_key

UNKNOWN_KEY = -1


def change_flags(df: DataFrame, key: str, period: str, attributes: list[str]) -> DataFrame:
    """Adds ``changed``: 1 when any attribute differs from the previous row.

    NULL-safe. The previous row is the key's previous stored period, so a
    missing month is no change. A first row counts as changed unless all its
    attributes are NULL.
    """
    w = W.partitionBy(key).orderBy(period)
    now = F.struct(*attributes)
    before = F.lag(now).over(w)
    first = reduce(or_, [F.col(a).isNotNull() for a in attributes])
    flag = F.when(before.isNull(), first).otherwise(~now.eqNullSafe(before))
    return df.withColumn("changed", flag.cast("int"))


def version_history(
    df: DataFrame, key: str, period: str, attributes: list[str], as_of: str = "key"
) -> DataFrame:
    """Version bounds per (key, period) row; the grain is not collapsed.

    ``effective_from`` is the first month of the row's version,
    ``effective_to`` its last month or NULL while it is current. With
    ``as_of="key"`` a key's last version is current even if the key has since
    vanished; ``"global"`` also asks it to reach the latest period of all.

    A key has one row per period, so its group is bounded by the number of
    periods. One shuffle on the key serves every window: bounds are carried
    along the rows (the opening month forwards, the closing month backwards)
    rather than regrouped by version.
    """
    forward = W.partitionBy(key).orderBy(period)
    so_far = forward.rowsBetween(W.unboundedPreceding, W.currentRow)
    later = W.partitionBy(key).orderBy(F.col(period).desc()).rowsBetween(W.unboundedPreceding, -1)

    month = month_key(period)
    now = F.struct(*attributes)
    before = F.lag(F.struct(month.alias("month"), now.alias("row"))).over(forward)
    opens = F.col("_before").isNull() | ~F.col("_now").eqNullSafe(F.col("_before.row"))

    marked = df.dropna(subset=[key, period]).select(
        "*", month.alias("month_key"), now.alias("_now"), before.alias("_before")
    ).select(
        "*",
        F.when(opens, F.col("month_key")).alias("_opened"),
        F.when(opens, F.col("_before.month")).alias("_closed"),
    )
    bounded = marked.select(
        "*",
        F.max("_opened").over(so_far).alias("effective_from"),
        F.min("_closed").over(later).alias("effective_to"),
    )
    result = bounded.withColumn("is_current", F.col("effective_to").isNull())
    if as_of == "global":
        last = df.agg(F.max(month).alias("last")).scalar()
        own_last = F.max("month_key").over(W.partitionBy(key))
        result = result.withColumn("_last", own_last).withColumn(
            "is_current", F.col("is_current") & (F.col("_last") == last)
        ).withColumn(
            "effective_to",
            F.when(~F.col("is_current"), F.coalesce("effective_to", "_last")),
        ).drop("_last")
    return result.drop("_now", "_before", "_opened", "_closed")


def dimension(
    snapshots: DataFrame, key: str, period: str, attributes: list[str], as_of: str = "key"
) -> DataFrame:
    """Dimension rows: surrogate key, bounds and attributes per (key, month)."""
    return version_history(snapshots, key, period, attributes, as_of).select(
        surrogate_key(key, "month_key").alias("provider_key"),
        key, "month_key", "effective_from", "effective_to", "is_current", *attributes,
    )


def with_unknown(dim: DataFrame, key: str = "provnum", name: str = "provider_name") -> DataFrame:
    """Appends the member that facts without a dimension row point to."""
    known = {
        "provider_key": F.lit(UNKNOWN_KEY), key: F.lit("UNKNOWN"), "month_key": F.lit(0),
        "effective_from": F.lit(0), "is_current": F.lit(True), name: F.lit("Unknown"),
    }
    row = dim.sparkSession.range(1).select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(row)


def latest_attributes(dim: DataFrame, key: str, attributes: list[str], order: str = "month_key") -> DataFrame:
    """One row per key with its most recent attributes, sentinel excluded.

    ``max_by`` combines map-side, so a key's history never meets in one task.
    """
    latest = F.max_by(F.struct(*attributes), order).alias("_latest")
    return dim.where(F.col(key) != "UNKNOWN").groupBy(key).agg(latest).select(key, "_latest.*")
