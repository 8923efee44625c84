"""Every registered query against its SQL in an independent engine."""

from __future__ import annotations

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from millrace.plans.catalog import QUERIES
from millrace.plans.oracle import ORACLES

#: Also at the size where the results are recorded, unless told otherwise.
SIZES = os.environ.get("TEST_SF_DIRS", "/root/testdata/sf0.001,/root/testdata/sf0.01").split(",")


@pytest.fixture(scope="session")
def duck():
    return {sf: connect(sf) for sf in SIZES}


#: Whole runs over a lake; they take long, so they are tested at the size where the results are recorded.
WHOLE_RUNS = {"changed_files", "gold_refresh", "touched_dimension"}


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql_and_has_rows(spark, duck, name, size):
    if name in WHOLE_RUNS and size != SIZES[-1]:
        pytest.skip("a whole run")
    assert compare(QUERIES[name](spark, size), duck[size], ORACLES[name]) is None
    assert duck[size].execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchone()[0] > 0


@pytest.mark.parametrize("size", SIZES)
def test_both_sides_of_each_branch_have_rows(duck, size):
    def values(name: str, column: str) -> set:
        return {r[0] for r in duck[size].execute(f'SELECT DISTINCT "{column}" FROM ({ORACLES[name]})').fetchall()}

    assert values("error_class", "error_class") == {"DATA_ERROR", "TRANSIENT"}
    assert values("change_detect", "change") == {"NEW", "SKIP", "RETRY", "CHANGED"}
    assert values("name_collisions", "outcome") == {"LOAD", "SKIP"}
    assert values("type_violations", "column") == {"provnum", "county_fips", "state", "hrs_rn", "workdate"}
    assert values("encodings", "is_utf8") == {True, False}
    refused = duck[size].execute("SELECT count(DISTINCT l_orderkey % 500) FROM lineitem").fetchone()[0]
    assert 0 < len(values("reject_files", "file")) < refused
    assert None in values("incremental_upsert", "stamp")


@pytest.mark.parametrize("size", SIZES)
def test_calendar_joins_lose_no_fact(spark, size):
    from millrace.plans import catalog

    days = sum(r["days"] for r in QUERIES["calendar_join"](spark, size).select("days").collect())
    assert days == catalog._measures(spark, size).count()
    months = QUERIES["month_calendar_join"](spark, size)
    assert months.count() == catalog._quality(spark, size).count() and months.where("year IS NULL").isEmpty()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "hprd" in df.columns
