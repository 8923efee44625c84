"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected equally often in the mix. Running totals
of these expectations are laid along each source, shifted by one random offset,
and a document is emitted once for every whole number its stretch crosses. The
documents of a source lie in order of size, so small and large ones are drawn
in proportion and the words taken stay close to the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import attach, ranked, same, word_count
from millrace.session import written

WEIGHTS = (5, 2, 1)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = (3, 2), most: int = 2
) -> DataFrame:
    """Words wanted of each source: ``source, source_size, target``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    ``share[0] / share[1]`` of all words. A target stops at ``most`` times its
    source's words; the excess goes to the others by weight until none is
    above. Each round of that is one sum over the sources, so any number of
    sources stays distributed.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*map(F.lit, weights))
    order = [F.col("source").asc_nulls_last()]
    weighed = ranked(sources, [], order, "place").select(
        "source", "source_size",
        F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")).cast("long").alias("weight"),
    )
    weighed = written(weighed, "sources")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    # Shares of the excess are kept as whole numbers: free / (share[1] * open_weight) words a weight.
    free, open_weight = share[0] * total, weighed.agg(F.sum("weight")).first()[0] or 1
    while True:
        above = F.lit(share[1] * most).cast("decimal(38,0)") * F.col("source_size") * F.lit(open_weight) < (
            F.col("weight").cast("decimal(38,0)") * F.lit(free)
        )
        held = weighed.filter(above).agg(F.sum("source_size"), F.sum("weight")).first()
        left = share[0] * total - share[1] * most * (held[0] or 0)
        weight = (weighed.agg(F.sum("weight")).first()[0] or 1) - (held[1] or 0)
        if weight == 0 or (left, weight) == (free, open_weight):
            break
        free, open_weight = left, weight
    even = F.col("weight") * F.lit(float(free)) / F.lit(float(share[1] * open_weight))
    target = F.when(above, F.col("source_size") * F.lit(float(most))).otherwise(even)
    return weighed.select("source", "source_size", target.alias("target"))


def offset(seed: str, source: Column) -> Column:
    """The random offset of a source, in [0, 1), the same in every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(source, F.lit("")))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def mix_counts(
    docs: DataFrame, seed: str = "mix", weights: Sequence[int] = WEIGHTS, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """How often the mix takes each document.

    Columns: ``id_col, source, size, source_size, target, copies, taken``. A
    null text has no words; a null source is a source of its own, placed last.
    A source without words gets target 0 and no copies. No document is taken
    more than twice. Rows with one id, source and size may swap their copies.
    Other columns are not read; an empty table gives an empty result.
    """
    sizes = written(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size")
        ),
        "sizes",
    )
    targets = written(source_targets(sizes, weights), "targets")
    spread = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    placed = ranked(sizes, ["source"], [F.asc("size"), spread.asc(), F.asc("doc_id")], "place")
    joined = placed.join(targets, same(placed, targets, ["source"])).select(
        placed["doc_id"].alias(id_col), placed["source"], placed["size"], "source_size", "target", "place"
    )
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = offset(seed, F.col("source"))
    crossed = F.floor((F.col("place") + 1) * expected + start) - F.floor(F.col("place") * expected + start)
    return joined.withColumn("copies", crossed.cast("long")).withColumn(
        "taken", F.col("copies") * F.col("size")
    ).drop("place")


def mixed(
    docs: DataFrame, seed: str = "mix", weights: Sequence[int] = WEIGHTS, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it."""
    counts = mix_counts(docs, seed, weights, id_col, text_col, source_col).select(
        F.col(id_col).alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"),
        F.col("copies").alias("__copies"),
    )
    keys = {"__id": F.col(id_col), "__source": F.col(source_col), "__size": word_count(text_col)}
    taken = attach(docs, counts, keys, ["__copies"])
    copies = F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))
    return taken.filter("__copies > 0").withColumn("__copy", copies).select(docs.columns)
