"""Exploration: inventory, dictionary, column profile, duplicates, grain."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.keys import date_of

LONG_TEXT = 64


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, largest first."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return _union(counts).orderBy(F.desc("row_count"), "table_name")


def column_dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    """Table, position, name, type and nullability of every column, with the
    number of rows and of values it holds."""

    def describe(name: str, df: DataFrame) -> DataFrame:
        entries = [
            F.struct(
                F.lit(place).alias("ordinal_position"), F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("is_nullable"), F.col(f"`c{place}`").alias("non_null"),
            )
            for place, f in enumerate(df.schema.fields, 1)
        ]
        counts = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns, 1)]
        return (
            df.agg(F.count("*").alias("row_count"), *counts)
            .select(F.lit(name).alias("table_name"), "row_count", F.explode(F.array(*entries)).alias("e"))
            .select("table_name", "e.*", "row_count")
        )

    return _union([describe(n, df) for n, df in tables.items()]).orderBy("table_name", "ordinal_position")


def sample_rows(df: DataFrame, key: list[str], n: int = 100) -> DataFrame:
    """First ``n`` rows by key; ordered so that it can be repeated."""
    return df.orderBy(*key).limit(n)


def _digestible(field: T.StructField) -> Column:
    """Text form that is equal exactly when the values are."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0.0).cast(field.dataType)).cast("string")  # -0.0 equals 0.0
    if isinstance(field.dataType, T.StringType):
        return c
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(c)
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def _compact(text: Column) -> Column:
    """Long text as its SHA-256, so that distinct counts shuffle digests."""
    return F.when(F.length(text) > LONG_TEXT, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(text)


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, values, NULLs, distinct values and percentages per column.

    One scan. The exact form counts (column, value) pairs, which combine
    map-side and spread over the shuffle by value, so that neither a frequent
    value nor a wide table lands in one task. ``approximate`` keeps one sketch
    per column and shuffles nothing else.
    """
    fields = df.schema.fields
    texts = df.select(*[_compact(_digestible(f)).alias(f.name) for f in fields])
    if approximate:
        wide = texts.agg(
            F.count("*").alias("total_rows"),
            *[
                F.struct(F.count(F.col(f"`{f.name}`")).alias("non_null"),
                         F.approx_count_distinct(F.col(f"`{f.name}`")).alias("distinct_values")).alias(f.name)
                for f in fields
            ],
        )
        entries = F.array(*[
            F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`.non_null"),
                     F.col(f"`{f.name}`.distinct_values"))
            for f in fields
        ])
        counted = wide.select("total_rows", F.explode(entries).alias("e")).select("total_rows", "e.*")
    else:
        counted = (
            texts.unpivot([], [f.name for f in fields], "column_name", "value")
            .groupBy("column_name", "value").agg(F.count("*").alias("copies"))
            .groupBy("column_name")
            .agg(
                F.sum("copies").alias("total_rows"),
                F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("copies"))), F.lit(0)).alias("non_null"),
                F.count("value").alias("distinct_values"),
            )
        )

    def percent(part: Column) -> Column:
        return F.round(F.try_divide(part.cast("double") * 100.0, F.col("total_rows").cast("double")), 2)

    nulls = F.col("total_rows") - F.col("non_null")
    return counted.select(
        "column_name", "total_rows", "non_null", nulls.alias("nulls"),
        percent(nulls).alias("null_pct"), "distinct_values",
        percent(F.col("distinct_values")).alias("distinct_pct"),
    )


def full_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each fully equal group.

    The shuffle carries a 32-byte SHA-256 of the whole row. Field names are
    part of the digest input, so (NULL, 1) and (1, NULL) differ.
    """
    row = F.to_json(F.struct(*[_digestible(f).alias(f.name) for f in df.schema.fields]))
    return (
        df.select(F.unhex(F.sha2(row, 256)).alias("row"))
        .groupBy("row").agg(F.count("*").alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("full_dup_rows"))
    )


def key_multiplicity(df: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated keys, most frequent first; NULL is a key like any other."""
    return (
        df.groupBy(*keys).agg(F.count("*").alias("cnt")).where("cnt > 1")
        .orderBy(F.desc("cnt"), *keys)
    )


def day_span(df: DataFrame, day_key: str) -> DataFrame:
    """Days between the first and last date of an integer date column."""
    return df.agg(F.datediff(F.max(date_of(day_key)), F.min(date_of(day_key))).alias("days"))


def grain_test(df: DataFrame, candidates: list[list[str]]) -> DataFrame:
    """Repeated keys per candidate key; a grain has none. NULL keys ignored.

    Grouping sets count every candidate in one scan and one shuffle, and the
    counts combine before it.
    """
    columns = list(dict.fromkeys(c for keys in candidates for c in keys))
    grouped = df.groupingSets([[F.col(c) for c in keys] for keys in candidates], *columns).agg(
        F.grouping_id().alias("set"), F.count("*").alias("copies")
    )

    def set_id(keys: list[str]) -> int:
        return sum(1 << i for i, c in enumerate(reversed(columns)) if c not in keys)

    candidate = F.coalesce(*[
        F.when(
            (F.col("set") == set_id(keys)) & reduce(and_, [F.col(c).isNotNull() for c in keys]),
            F.lit("+".join(keys)),
        )
        for keys in candidates
    ])
    repeated = F.count_if(F.col("copies") > 1)
    return (
        grouped.withColumn("candidate", candidate).dropna(subset=["candidate"])
        .groupBy("candidate")
        .agg(repeated.alias("duplicate_keys"), (repeated == 0).alias("is_grain"))
    )
