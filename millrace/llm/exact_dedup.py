"""Exact deduplication through content-defined chunk recipes.

A text without its white space is cut where its content says so, each chunk
gets an identifier, and two texts are equal when their ordered identifier lists
are. Chunk text crosses the network once, to prove that an identifier stands
for one text only; after that only lists of 8-byte identifiers move, never
documents. Everything is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import attach, same, text_or_empty, without_blanks
from millrace.session import written


@dataclass(frozen=True)
class ChunkRule:
    """Cut at the first place after ``least`` characters where the three
    characters before it have code points of the given remainders mod 8 (among
    the first 256 code points), at the latest after ``most`` characters."""

    least: int = 256
    most: int = 4096
    remainders: tuple[int, int, int] = (5, 6, 4)

    def pattern(self) -> str:
        before = "".join(
            "[" + "".join(rf"\x{c:02x}" for c in range(r, 256, 8)) + "]" for r in self.remainders
        )
        return rf"(?s).{{{self.least},{self.most}}}?(?<={before})|.{{1,{self.most}}}"


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: ChunkRule = ChunkRule(),
    chunk_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per document: which document of its group of equal texts stays.

    Columns: ``id_col``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, ``n_points`` (code points of the original text). Texts are
    equal when they are after deleting white space; a null text counts as
    empty, and empty texts equal each other. Of a group the row with the most
    code points stays, then the smallest id, null ids last; of rows that agree
    in both, one. Other columns of ``docs`` play no part. An empty table gives
    an empty result. Ids need not be unique.
    """
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.char_length(text_or_empty(text_col)).cast("long").alias("n_points"),
        without_blanks(text_col).alias("bare"),
    ).withColumn("chunks", F.regexp_extract_all("bare", F.lit(rule.pattern()), 0))
    recipes = texts.select(
        "id", "n_points", F.sha2("bare", 256).alias("sha"), F.transform("chunks", lambda c: chunk_hash(c)).alias("recipe")
    )
    chunks = texts.select(F.explode("chunks").alias("chunk")).withColumn("chunk_id", chunk_hash(F.col("chunk")))
    shared = written(
        chunks.distinct().groupBy("chunk_id").count().filter("count > 1").select("chunk_id"), "shared-ids"
    )
    if shared.isEmpty():
        recipes = recipes.withColumn("told_apart", F.lit(None).cast("array<struct<pos:int,nth:int>>"))
    else:
        recipes = _told_apart(texts, recipes, shared, chunk_hash)
    group = ["recipe", "told_apart"]
    rows = written(
        recipes.groupBy("id", "n_points", "sha", *group).agg(F.count("*").alias("copies")), "recipes"
    )
    best = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("id").isNull().alias("n"), "id"))
    groups = rows.groupBy(*group).agg(best.alias("best"), F.sum("copies").alias("group_size"))
    stays = (rows["n_points"] == -F.col("best.p")) & rows["id"].eqNullSafe(F.col("best.id"))
    return (
        rows.join(groups, same(rows, groups, group))
        .select(
            rows["id"].alias(id_col), F.col("best.id").alias("keep_id"), "group_size", stays.alias("stays"),
            rows["sha"].alias("text_sha256"), rows["n_points"],
            F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
        )
        .select(
            id_col, "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"),
            "text_sha256", "n_points",
        )
    )


def _told_apart(
    texts: DataFrame, recipes: DataFrame, shared: DataFrame, chunk_hash: Callable[[Column], Column]
) -> DataFrame:
    """``recipes`` with, for every chunk whose identifier several chunk texts
    share, its place and the rank of its text among those."""
    placed = texts.select("id", "sha" if "sha" in texts.columns else F.sha2("bare", 256).alias("sha"),
                          F.posexplode("chunks").alias("pos", "chunk"))
    placed = placed.withColumn("chunk_id", chunk_hash(F.col("chunk"))).join(shared, "chunk_id", "left_semi")
    ranks = placed.select("chunk_id", "chunk").distinct().withColumn(
        "nth", F.row_number().over(Window.partitionBy("chunk_id").orderBy("chunk"))
    )
    marks = (
        placed.join(ranks, ["chunk_id", "chunk"])
        .groupBy("id", "sha")
        .agg(F.array_sort(F.collect_set(F.struct("pos", "nth"))).alias("told_apart"))
    )
    return recipes.join(marks, same(recipes, marks, ["id", "sha"]), "left").select(
        *[recipes[c] for c in recipes.columns], marks["told_apart"]
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    found = exact_duplicates(docs, id_col, text_col).select(
        F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha"), F.col("n_points").alias("__points"),
        F.col("kept").alias("__kept"),
    )
    keys = {
        "__id": F.col(id_col),
        "__sha": F.sha2(without_blanks(text_col), 256),
        "__points": F.char_length(text_or_empty(text_col)).cast("long"),
    }
    return attach(docs, found, keys, ["__kept"]).filter("__kept").select(docs.columns)
