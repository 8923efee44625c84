"""Keyed writes expressed as one outer join per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[Column], order_is_total: bool = False
) -> DataFrame:
    """First row per key in ``order``, NULL keys dropped.

    Ties are broken by every remaining column, so the winner never depends on
    task order; they are named one by one, as a struct of them would be sorted
    and shuffled beside the row it repeats. ``order_is_total`` says that
    ``order`` leaves no ties, which spares reading columns nobody else asks for. ``row_number() = 1`` becomes
    a group limit that runs before the shuffle: each map task sends one row
    per key, however hot the key is.
    """
    rest = [] if order_is_total else [F.col(f"`{c}`").desc() for c in df.columns if c not in keys]
    w = W.partitionBy(*keys).orderBy(*order, *rest)
    return (
        df.dropna(subset=keys).withColumn("_rank", F.row_number().over(w))
        .where("_rank = 1").drop("_rank")
    )


def wins(stamp: Column, digest: Column, old_stamp: Column, old_digest: Column) -> Column:
    """Newer stamp wins, then the greater digest.

    Stamps are compared as text. A NULL on either side is never a win, so a
    stored row without a stamp stays.
    """
    return F.coalesce(
        (stamp > old_stamp) | ((stamp == old_stamp) & (digest > old_digest)), F.lit(False)
    )


def merge_candidates(
    target: DataFrame, incoming: DataFrame, keys: list[str], stamp: str, digest: str
) -> DataFrame:
    """Incoming rows that insert or overwrite. One incoming row per key."""
    old = target.select(
        *keys, F.lit(True).alias("_hit"), F.col(stamp).alias("_stamp"), F.col(digest).alias("_digest")
    )
    return (
        incoming.join(old, keys, "left")
        .where(
            F.col("_hit").isNull()
            | wins(F.col(stamp), F.col(digest), F.col("_stamp"), F.col("_digest"))
        )
        .select(incoming.columns)
    )


def upsert_latest(
    target: DataFrame, incoming: DataFrame, keys: list[str], stamp: str, digest: str
) -> DataFrame:
    """Target after the last-writer-wins merge of ``incoming``.

    Both sides hold one row per key (``latest_per_key``), so one outer join
    reads and shuffles each side once and cannot skew.
    """
    new_wins = F.col("_old").isNull() | wins(
        F.col(f"_new.{stamp}"), F.col(f"_new.{digest}"), F.col(f"_old.{stamp}"), F.col(f"_old.{digest}")
    )
    return _outer_pick(target, incoming, keys, new_wins)


def replace_matching(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows replace target rows of the same key; the rest stay."""
    return _outer_pick(target, incoming, keys, F.lit(True))


def _outer_pick(target: DataFrame, incoming: DataFrame, keys: list[str], new_wins: Column) -> DataFrame:
    columns = target.columns
    values = ", ".join(f"`{c}`" for c in columns if c not in keys)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.selectExpr(*keys, f"struct({values}) AS {name}")

    both = side(target, "_old").join(side(incoming, "_new"), keys, "full_outer")
    picked = F.when(F.col("_new").isNotNull() & new_wins, F.col("_new")).otherwise(F.col("_old"))
    return both.select(*keys, picked.alias("_row")).select(*keys, "_row.*").select(columns)


def replace_snapshots(
    target: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    period: str,
    arrival: list[Column],
    newest_wins: str | None = None,
) -> DataFrame:
    """Snapshot replace within each period of the batch.

    A stored row is replaced when the batch holds its (period, key); other
    periods and keys absent from the batch stay. The last arrival wins, even
    over newer stored rows. ``newest_wins`` names a stamp column to make the
    newest stamp win instead.
    """
    key = [period, *keys]
    order = [F.col(newest_wins).desc_nulls_last(), *arrival] if newest_wins else arrival
    batch = latest_per_key(incoming, key, order)
    if newest_wins is None:
        return replace_matching(target, batch, key)
    newer = F.col("_old").isNull() | F.coalesce(
        F.col(f"_new.{newest_wins}") >= F.col(f"_old.{newest_wins}"), F.lit(False)
    )
    return _outer_pick(target, batch, key, newer)
