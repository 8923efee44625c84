"""Registered queries: SQL where there is some, whole results elsewhere; the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm.oracle import ORACLES
from millrace.llm.queries import QUERIES


def test_all_thirteen_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op3_secret_scan", "pipeline"}))
def test_one_row_per_document(spark, sf_dir, name):
    source, key = ("pages", "page_id") if name.startswith("op7_") else ("documents", "doc_id")
    want = Counter(r[0] for r in spark.read.parquet(f"{sf_dir}/{source}.parquet").select(key).collect())
    assert Counter(r[0] for r in QUERIES[name](spark, sf_dir).select(key).collect()) == want


def test_pipeline_stages_take_effect(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(n)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(n)))
        counts.append(docs.count())
        if n < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if n < 3:
            assert docs.join(before, "doc_id", "left_anti").count() == 0
            assert docs.select("doc_id").distinct().count() == docs.count()
    assert counts[2] < counts[1] and counts[3] <= counts[2] and counts[5] == counts[4] > 0
    assert docs.filter(F.col("n_tokens") > 0).count() > 0
