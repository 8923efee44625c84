"""Totals of month ranges from running sums, against totals of the days."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest

from millrace.operators import metrics, running
from millrace.plans import gold
from millrace.plans.lake import Lake
from millrace.plans.report import Report

FACT = "provnum string, month_key int, mdscensus smallint, total_direct_care_hours decimal(9,2), contract_direct_care_hours decimal(9,2)"


def days(seed: int) -> list[tuple]:
    """Facilities with gaps, months without days, unknown values and names, years that turn."""
    rng, out = random.Random(seed), []
    for name in ("a", "b", "c", None, "only", "unknown"):
        months = [202311] if name == "only" else rng.sample([202309, 202310, 202312, 202401, 202403, 202405], 4)
        for month in months:
            for _ in range(rng.randrange(1, 5)):
                census = None if name == "unknown" or rng.random() < 0.2 else rng.randrange(0, 90)
                hours = None if rng.random() < 0.2 else Decimal(rng.randrange(0, 90000)) / 100
                out.append((name, month, census, hours, None if rng.random() < 0.5 else Decimal("1.25")))
    return out


def of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


RANGES = [(202309, 202405), (202310, 202312), (202311, 202311), (202402, 202402), (202001, 202309), (202404, 203012),
          (202001, 202301), (202501, 202601), (202405, 202309)]


def test_every_range_equals_the_days(spark, tmp_path):
    for seed in (1, 2):
        facts = spark.createDataFrame(days(seed), FACT).cache()
        path = str(tmp_path / str(seed))
        running.running_sums(facts).write.partitionBy("month_key").parquet(path)
        sums = spark.read.parquet(path)
        months = [r.month_key for r in sums.select("month_key").distinct().collect()]
        assert {202311, 202402, 202404} <= set(months)
        for start, end in RANGES:
            want = metrics.facility_totals(metrics.in_months(facts, start, end))
            got = running.range_totals(sums, *running.bounding_months(months, start, end))
            assert of(got) == of(want), (seed, start, end)
            assert got.schema.simpleString() == want.schema.simpleString()


def test_no_days_and_days_without_a_month(spark):
    none = spark.createDataFrame([], FACT)
    assert running.running_sums(none).count() == 0
    undated = spark.createDataFrame([("a", None, 1, None, None), ("b", 202401, 2, None, None)], FACT)
    assert [r.provnum for r in running.running_sums(undated).collect()] == ["b"]
    assert running.range_totals(running.running_sums(undated), None, None).count() == 0


def test_a_report_reads_two_months_of_the_current_version(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    facts = spark.createDataFrame(days(3), FACT)
    lake.stored(gold.DAILY, "month_key").replace(facts)
    blank = ", ".join(f"CAST(NULL AS {'int' if c == 'certified_beds' else 'string'}) AS {c}" for c in metrics.ATTRIBUTES)
    dim = spark.sql(f"SELECT 'a' AS provnum, 202401 AS month_key, 20240101 AS snapshot_date_key, {blank}")
    lake.stored(gold.PROVIDERS).replace(dim)
    with pytest.raises(FileNotFoundError):
        gold.refresh_sums(Lake(spark, str(tmp_path / "other")))

    def totals(start, end):
        return gold.range_totals(lake, lake.stored(gold.DAILY).newest(), start, end)

    assert totals(202310, 202401) is None
    gold.refresh_sums(lake)
    files = totals(202310, 202401).inputFiles()
    assert {f.split("month_key=")[1][:6] for f in files} == {"202309", "202401"}
    before = of(metrics.facility_metrics(metrics.in_months(facts, 202310, 202401), dim))
    with Report(lake, 202310, 202401) as report:
        assert of(report.all_facilities.select("provnum", *metrics.ATTRIBUTES, "reporting_days", "avg_census",
                                               "contract_hours_total", "hprd", "contract_mix", "contract_reliance")) == before
    lake.stored(gold.DAILY, "month_key").append(facts.where("provnum = 'a'").limit(1))
    assert totals(202310, 202401) is None
    gold.refresh_sums(lake)
    assert of(totals(202309, 202405)) == of(metrics.facility_totals(lake.stored(gold.DAILY).read()))
