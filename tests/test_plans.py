"""Physical plans of the registered queries."""

from __future__ import annotations

import re

import pytest

from millrace.plans.catalog import QUERIES

UNWANTED = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"incremental_upsert", "content_md5"}))
def test_plan_has_no_nested_loops_or_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not UNWANTED.search(plan)


def test_projection_reads_only_its_columns(spark, sf_dir):
    plan = QUERIES["dup_keys"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan
