"""Report frames: per-facility ratios, rollups, filters and headline figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import is_month_key, month_label
from millrace.functions.numbers import ratio, weighted_mean

# Staffing reference bands, hours per resident-day.
HPRD_LOW = 3.0
HPRD_TARGET = 3.48

# The provider attributes that reports show.
ATTRIBUTES = [
    "provider_name", "state", "county_name", "ownership_type", "provider_type", "certified_beds",
]
SUM = "decimal(38,2)"


def month_bounds(facts: DataFrame, month: str = "month_key") -> DataFrame:
    """First and last month, (0, 0) when there are no facts."""
    return facts.agg(
        F.coalesce(F.min(month), F.lit(0)).alias("min_month"),
        F.coalesce(F.max(month), F.lit(0)).alias("max_month"),
    )


def month_list(bounds: DataFrame) -> DataFrame:
    """Every calendar month between the bounds, with its label."""
    return (
        bounds.select(F.explode(F.sequence("min_month", "max_month")).alias("month_key"))
        .where(is_month_key("month_key"))
        .select("month_key", month_label("month_key").alias("month"))
    )


def in_months(facts: DataFrame, start: int, end: int, month: str = "month_key") -> DataFrame:
    """Inclusive range on the bare column, so partitions are pruned."""
    return facts.where(F.col(month).between(start, end))


def facility_totals(facts: DataFrame) -> DataFrame:
    """Additive totals per facility; the day rows combine before the shuffle."""
    return facts.groupBy("provnum").agg(
        F.count("*").alias("reporting_days"),
        F.avg(F.col("mdscensus").cast("double")).alias("avg_census"),
        F.sum("mdscensus").alias("sum_census"),
        F.sum("total_direct_care_hours").cast(SUM).alias("sum_hours"),
        F.sum("contract_direct_care_hours").cast(SUM).alias("sum_ctr_hours"),
    )


def facility_metrics(facts: DataFrame, attributes: DataFrame) -> DataFrame:
    """One row per facility: hours per resident-day, contract mix and reliance.

    Ratios are ratios of sums over the period. Beds are one number per
    facility and never summed over days. Facts are aggregated before the join.
    """
    return facility_ratios(facility_totals(facts), attributes)


def facility_ratios(totals: DataFrame, attributes: DataFrame) -> DataFrame:
    """The ratios of totals per facility, beside its attributes."""
    have = [c for c in ATTRIBUTES if c in attributes.columns]
    return (
        totals
        .join(attributes.select("provnum", *have), "provnum", "left")
        .select(
            "provnum",
            *have,
            "reporting_days",
            "avg_census",
            F.col("sum_ctr_hours").alias("contract_hours_total"),
            ratio("sum_hours", "sum_census").alias("hprd"),
            ratio("sum_ctr_hours", "sum_hours").alias("contract_mix"),
            ratio("sum_ctr_hours", "certified_beds").alias("contract_reliance"),
        )
    )


def monthly_trend(facts: DataFrame, attributes: DataFrame) -> DataFrame:
    """Sums by month, state and ownership, unknown groups kept.

    Days fold to (month, facility) before the join, which then meets one row
    per facility and month instead of one per day.
    """
    sums = ["sum_census", "sum_hours", "sum_ctr_hours"]
    monthly = facts.groupBy("month_key", "provnum").agg(
        F.sum("mdscensus").alias("sum_census"),
        F.sum("total_direct_care_hours").alias("sum_hours"),
        F.sum("contract_direct_care_hours").alias("sum_ctr_hours"),
    )
    return (
        monthly.join(attributes.select("provnum", "state", "ownership_type"), "provnum", "left")
        .groupBy("month_key", "state", "ownership_type")
        .agg(*[F.sum(c).cast("bigint" if c == "sum_census" else SUM).alias(c) for c in sums])
        .orderBy("month_key", "state", "ownership_type")
    )


def filter_options(facilities: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values of each column, sorted, from one scan."""
    return (
        facilities.select(*[F.col(c).cast("string") for c in columns])
        .unpivot([], list(columns), "filter", "option")
        .dropna(subset=["option"])
        .distinct()
        .orderBy("filter", "option")
    )


def filter_facilities(
    facilities: DataFrame,
    states: Sequence[str] = (),
    ownerships: Sequence[str] = (),
    provider_types: Sequence[str] = (),
    min_days: int = 30,
) -> DataFrame:
    """Selected facilities; an empty choice selects all."""
    kept = facilities.where((F.col("reporting_days") >= min_days) & F.col("hprd").isNotNull())
    for column, chosen in (
        ("state", states), ("ownership_type", ownerships), ("provider_type", provider_types),
    ):
        if chosen:
            kept = kept.where(F.col(column).isin(list(chosen)))
    return kept


def headline(facilities: DataFrame) -> DataFrame:
    """The headline row: counts, weighted averages and share below target.

    Rates are weighted by average census, reliance by beds over the rows that
    have one.
    """
    has_reliance = F.col("contract_reliance").isNotNull()
    below = F.count_if(F.col("hprd") < HPRD_TARGET)
    return facilities.agg(
        F.count("*").alias("facilities"),
        F.count_distinct("state").alias("states"),
        weighted_mean("hprd", "avg_census").alias("avg_hprd"),
        weighted_mean("contract_mix", "avg_census").alias("avg_mix"),
        F.try_divide(
            F.sum(F.when(has_reliance, F.col("contract_hours_total"))).cast("double"),
            F.sum(F.when(has_reliance, F.col("certified_beds"))).cast("double"),
        ).alias("avg_reliance"),
        below.alias("below_target"),
        F.try_divide(below * F.lit(100.0), F.count("*")).alias("below_target_pct"),
    )


def by_state(facilities: DataFrame) -> DataFrame:
    """Census-weighted rates per known state, lowest staffing first."""
    return (
        facilities.dropna(subset=["state"])
        .groupBy("state")
        .agg(
            F.count("*").alias("facilities"),
            F.sum("avg_census").alias("census"),
            weighted_mean("hprd", "avg_census").alias("hprd"),
            weighted_mean("contract_mix", "avg_census").alias("contract_mix"),
        )
        .orderBy("hprd", "state")
    )


def system_trend(
    trend: DataFrame, states: Sequence[str] = (), ownerships: Sequence[str] = ()
) -> DataFrame:
    """Trend rows re-aggregated to months.

    Only state and ownership apply here; the provider-type and minimum-days
    choices do not reach the trend.
    """
    kept = trend
    if states:
        kept = kept.where(F.col("state").isin(list(states)))
    if ownerships:
        kept = kept.where(F.col("ownership_type").isin(list(ownerships)))
    monthly = kept.groupBy("month_key").agg(
        F.sum("sum_hours").cast(SUM).alias("sum_hours"),
        F.sum("sum_census").alias("sum_census"),
        F.sum("sum_ctr_hours").cast(SUM).alias("sum_ctr"),
    )
    return monthly.select(
        "month_key", month_label("month_key").alias("month"), "sum_hours", "sum_census", "sum_ctr",
        F.try_divide(F.col("sum_hours").cast("double"), F.col("sum_census").cast("double")).alias("hprd"),
        F.try_divide(F.col("sum_ctr").cast("double"), F.col("sum_hours").cast("double")).alias("contract_mix"),
    ).orderBy("month_key")
