"""Quantiles, histograms, rankings and outlier flags over a report frame.

These read their input more than once; cache it when it is costly to compute.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from millrace.operators.metrics import HPRD_LOW, HPRD_TARGET

# Display names of report columns and flags.
LABELS = {
    "provnum": "CCN", "provider_name": "Facility", "state": "State",
    "ownership_type": "Ownership", "certified_beds": "Beds", "avg_census": "Avg census",
    "hprd": "HPRD", "contract_mix": "Contract mix", "contract_reliance": "Contract hrs/bed",
    "reporting_days": "Days",
}
FLAG_LABELS = {"critical": "🔴 Critical", "serious": "🟠 Serious"}


#: Counts that one pass over a column brings to the driver.
STEPS = 2048


def labelled(df: DataFrame, columns: list[str], labels: dict[str, str] = LABELS) -> DataFrame:
    return df.select(*[F.col(c).alias(labels.get(c, c)) for c in columns])


def quantiles(df: DataFrame, wanted: dict[str, float]) -> dict[str, float | None]:
    """Exact interpolated quantile of each column in ``wanted``, NULLs ignored.

    Equals ``percentile`` without gathering or ranking a column in one task.
    Like ``approxQuantile`` it runs at once and returns plain numbers. Values
    are counted in equal steps between least and greatest, then again within
    the step that holds the wanted rank, until few values are left. One pass
    narrows all columns at once, each some two thousand times, and brings at
    most ``STEPS`` counts a column to the driver, whatever the distribution.
    """
    xs = df.select(*[F.col(c).cast("double").alias(c) for c in wanted])
    bounds = xs.agg(
        *[F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in wanted]
    ).first()
    searches = {c: _Search(c, q, *bounds[c]) for c, q in wanted.items()}
    while still := [s for s in searches.values() if s.is_open]:
        counted = xs.select(F.explode(F.array(*[s.step() for s in still])).alias("_s")).where("_s.step IS NOT NULL")
        counts = counted.groupBy("_s.name", "_s.step").agg(
            F.count("*").alias("n"), F.min("_s.x").alias("low"), F.max("_s.x").alias("high")
        ).collect()
        for search in still:
            search.narrow(sorted((r for r in counts if r.name == search.column), key=lambda r: r.low))
    return {c: s.found for c, s in searches.items()}


class _Search:
    """The range of a column that holds a rank, from pass to pass."""

    def __init__(self, column: str, q: float, n: int, low: float | None, high: float | None) -> None:
        self.column, self.low, self.high = column, low, high
        self.below, self.inside = 0, n
        self.at = q * (n - 1)
        self.rank, self.upper = math.floor(self.at), math.ceil(self.at)
        self.is_open = n > 0 and low < high
        self.found = low

    def step(self) -> Column:
        """(name, x, step) of a row; the step is NULL outside the range."""
        x, width = F.col(self.column), (self.high - self.low) / STEPS
        if self.inside <= STEPS or self.low + width == self.low:
            step = x
        else:
            step = F.least(F.floor((x - self.low) / width), F.lit(STEPS - 1)).cast("double")
        return F.struct(
            F.lit(self.column).alias("name"), x.alias("x"), F.when(x.between(self.low, self.high), step).alias("step")
        )

    def narrow(self, counts: list[Row]) -> None:
        for here, after in zip(counts, [*counts[1:], None], strict=True):
            if self.below + here.n > self.rank:
                break
            self.below += here.n
        if self.below + here.n <= self.upper:
            self.found, self.is_open = here.high + (after.low - here.high) * (self.at - self.rank), False
            return
        self.low, self.high, self.inside = here.low, here.high, here.n
        self.found, self.is_open = here.low, here.low < here.high


def thresholds(facilities: DataFrame) -> DataFrame:
    """10th percentile of staffing and 90th of contract mix, one row."""
    at = quantiles(facilities, {"hprd": 0.10, "contract_mix": 0.90})
    return facilities.sparkSession.range(1).select(
        F.lit(at["hprd"]).cast("double").alias("hprd_p10"),
        F.lit(at["contract_mix"]).cast("double").alias("mix_p90"),
    )


def clipped(df: DataFrame, column: str, alias: str, q: float = 0.99) -> DataFrame:
    """Rows that have ``column``, plus a copy clipped at its upper quantile."""
    upper = F.lit(quantiles(df, {column: q})[column]).cast("double")
    return df.dropna(subset=[column]).withColumn(alias, F.least(F.col(column), upper))


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width bins between minimum and maximum; empty bins are absent.

    The bounds are one row; rows combine into at most ``bins`` groups before
    the shuffle.
    """
    x = F.col(column)
    low, high = df.agg(F.min(x).cast("double"), F.max(x).cast("double")).first()
    width = (high - low) / bins if low is not None else 0.0
    place = F.least(F.floor((x - low) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
    return (
        df.dropna(subset=[column])
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count("*").alias("facilities"))
        .select("bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_low"), "facilities")
    )


def scatter(df: DataFrame, x: str, y: str, extra: list[str]) -> DataFrame:
    """Point frame: x, y, size, colour and hover columns."""
    return df.select(x, y, *extra)


def ranking(df: DataFrame, column: str, largest: bool, n: int = 25, key: str = "provnum") -> DataFrame:
    """The ``n`` most extreme rows, NULLs excluded, ties broken by ``key``.

    Each task keeps its own ``n`` rows, so no full sort takes place.
    """
    order = F.col(column).desc() if largest else F.col(column).asc()
    return df.dropna(subset=[column]).orderBy(order, key).limit(n)


def flag_outliers(facilities: DataFrame) -> DataFrame:
    """Flagged facilities, worst staffing first.

    Critical below ``HPRD_LOW``; serious below ``HPRD_TARGET`` or with a
    contract mix above its 90th percentile. A NULL mix never flags.
    """
    mix_p90 = F.lit(quantiles(facilities, {"contract_mix": 0.90})["contract_mix"])
    flag = F.when(F.col("hprd") < HPRD_LOW, "critical").when(
        (F.col("hprd") < HPRD_TARGET) | (F.col("contract_mix") > mix_p90), "serious"
    )
    label = F.when(F.col("flag") == "critical", FLAG_LABELS["critical"]).otherwise(FLAG_LABELS["serious"])
    return (
        facilities.withColumn("flag", flag).dropna(subset=["flag"])
        .withColumn("Flag label", label).orderBy("hprd", "provnum")
    )
