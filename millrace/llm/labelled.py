"""A bounded sample of labelled documents for fitting a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 3, 1


def fold(id_col: str = "doc_id") -> Column:
    """Remainder of the CRC-32 of the id as text; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(FOLDS)).cast("int")


def held_out(id_col: str = "doc_id") -> Column:
    return fold(id_col) == HELD_OUT


def least_hashes(df: DataFrame, key: Column, most: int) -> DataFrame:
    """The ``most`` rows of ``df`` with the least MD5 of ``key``, in that order.

    Rows far from the front are dropped by the hash's leading digits first, so
    that no task sorts or sends more than its share of about ``4 * most`` rows.
    """
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    total = df.count()
    if total > 8 * most:
        df = df.filter(F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") < 4 * most / total * 2.0**48)
    return df.orderBy(digest).limit(most)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, per_value: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[list[bytes], list[int]]:
    """Texts (UTF-8) and labels of at most ``per_value`` documents per label value.

    Rows of the held-out fold and null labels never take part; of an id with
    several labels the greatest counts. Which rows are taken depends on a hash
    of their ids only. The sample is the one thing that reaches the driver.
    """
    known = (
        labels.filter(~held_out(id_col) & F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(id_col).agg(F.max(label).alias("label"))
    )
    order = F.md5(F.col(id_col).cast("string"))
    chosen = None
    for value in (0, 1):
        part = least_hashes(known.filter(F.col("label") == value), F.col(id_col), per_value)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (
        docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
        .join(F.broadcast(chosen), id_col).dropDuplicates([id_col]).orderBy(order)
        .select("text", "label").collect()
    )
    return [bytes(r["text"]) for r in rows], [int(r["label"]) for r in rows]
