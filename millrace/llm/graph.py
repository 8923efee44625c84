"""Connected components of an edge list too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``.

    The component is the least node. Alternating star contraction: every node
    hands its larger neighbours to its least neighbour, then its smaller ones,
    until each component is one star around its least node; the number of
    rounds grows with the logarithm of the longest path. The least neighbour is
    an aggregate joined back, so a node with very many neighbours is never
    gathered in one place. Each round is written to the shared folder.
    """
    stars = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        kept = low.select("a", F.col("low").alias("b"))
        moved = large.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = written(kept.unionByName(moved).distinct(), "stars")
        seen = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
