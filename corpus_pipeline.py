"""A corpus from raw documents: clean, distinct, mixed and tokenized.

``STAGES`` names the stages in order; each works on all rows that its
predecessor kept. ``run`` writes every stage as Parquet in the shared scratch
folder and reads it again, so a lost executor costs at most one stage.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.llm import bpe, exact_dedup, jaccard, mixing, toxicity  # noqa: E402
from millrace.llm.queries import table, vocabulary_path  # noqa: E402
from millrace.session import let_workers_import, scratch_path  # noqa: E402

def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not found toxic. The model learns from labelled rows
    of the raw table, so it is the same whatever ``docs`` holds."""
    let_workers_import(spark)
    model = toxicity.fitted(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicated(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of documents that share 85 % of their four-word shingles."""
    let_workers_import(spark)
    return jaccard.one_of_each(docs, words=4, percent=85)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares; a document may come twice."""
    return mixing.mixed(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, one row per document of the mix."""
    let_workers_import(spark)
    return bpe.digests(bpe.encoded(docs, vocabulary_path()))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing to target weights", mixed),
    ("BPE", tokenized),
]

#: The first stage is a trained network, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = table(let_workers_import(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
