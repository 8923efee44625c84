"""The registered queries: each operator over its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    alignment, bpe, embedding_dedup, exact_dedup, html_text, importance, jaccard, mixing, quality, secrets, sharding,
    token_counts, toxicity,
)
from millrace.session import let_workers_import

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(let_workers_import(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A tokenizer file that the contracts name."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark, sf_dir):
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


@query
def op3_secret_scan(spark, sf_dir):
    """Spans and scores; the values themselves stay out of the report."""
    found = secrets.scanned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


@query
def op4_sharding(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=8)


@query
def op5_mixing(spark, sf_dir):
    return mixing.mix_counts(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", F.col("source_size").cast("long"), "target", "taken"
    )


@query
def op6_bpe(spark, sf_dir):
    return bpe.digests(bpe.encoded(table(spark, sf_dir, "documents"), vocabulary_path()))


@query
def op7_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = html_text.extracted(pages, html_text.fitted(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op8_token_counts(spark, sf_dir):
    """Token counts before and after masking addresses, keys and numbers."""
    return token_counts.edited_counts(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op9_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fitted(docs, table(spark, sf_dir, "labels")))


@query
def op10_jaccard_join(spark, sf_dir):
    return jaccard.linked_documents(table(spark, sf_dir, "documents"), words=4, percent=85)


@query
def op11_alignment(spark, sf_dir):
    return alignment.aligned(table(spark, sf_dir, "documents"), vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))


@query
def op12_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


@query
def op13_importance_resampling(spark, sf_dir):
    drawn = importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def pipeline(spark, sf_dir):
    """Toxicity, exact dedup, Jaccard join, mixing and BPE, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
