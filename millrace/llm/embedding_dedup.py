"""Near copies among vectors: links by cosine within a label, and their components.

1. Equal vectors of a label are one vector with a weight.
2. Every vector goes to one cell per deal (see ``collisions``). A crowded cell
   is cut into tiles by a hash of the vector; each pair of tiles is a task's
   work, so no cell has to fit anywhere.
3. In a cell, collisions in sorted projections choose the pairs, and cosines
   verify them. A pair that meets in several deals counts in the first of them
   only, which both vectors' cells tell. Tasks return sums of weights and
   spanning links, one row per vector, never the pairs.
4. Spanning links join into components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.collisions import Calibration, calibrated, candidates, cells, depth_for, units
from millrace.llm.graph import components
from millrace.session import written

#: Vectors of a tile; a cell of more is cut.
TILE = 1024
_DOUBLES = "array<double>"


def _usable(embedding: str, label: str):
    """Rows that may link: a label, and a vector of finite numbers that aren't all zero."""
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(label).isNotNull() & F.coalesce(whole & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _dealt(classes: DataFrame, cosine: float) -> DataFrame:
    """Every class once per deal: its tile's key, its cells in all deals and the vector."""
    groups = classes.groupBy("_label", "_dim").agg(F.count("*").alias("_n"))
    sized = classes.join(groups, ["_label", "_dim"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, dims = batch.column(3), batch.column(4).to_numpy()
            depths = np.array([depth_for(n) for n in batch.column(5).to_pylist()], np.int64)
            for dim, depth in sorted(set(zip(dims.tolist(), depths.tolist()))):
                rows = np.flatnonzero((dims == dim) & (depths == depth))
                part = vectors.take(pa.array(rows))
                unit = units(part.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                found = cells(unit, depth, calibrated(dim, cosine).deals(depth))
                ends = np.arange(len(rows) + 1, dtype=np.int32) * found.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(pa.array(rows)) for k in (0, 1, 2)), pa.ListArray.from_arrays(ends, found.ravel()), part],
                    names=["_node", "_label", "_size", "_cells", "_vector"],
                )

    kind = classes.schema["_label"].dataType.simpleString()
    narrow = sized.select("_node", "_label", "_size", "_vector", "_dim", "_n")
    return narrow.mapInArrow(deal, f"_node string, _label {kind}, _size long, _cells array<long>, _vector {_DOUBLES}")


def _tiles(dealt: DataFrame, tile: int) -> DataFrame:
    """One row per vector, deal and pair of tiles; ``_side`` tells which of the two is the vector's."""
    placed = dealt.select("_node", "_label", "_vector", "_cells", "_size", F.posexplode("_cells").alias("_deal", "_cell"))
    key = ["_label", F.size("_vector").alias("_dim"), "_deal", "_cell"]
    counts = dealt.select("_label", "_vector", F.posexplode("_cells").alias("_deal", "_cell")).groupBy(*key).count().filter("count > 1")
    parts = counts.select("_label", F.col("_dim"), "_deal", "_cell", F.ceil(F.col("count") / tile).alias("_parts"))
    rows = placed.withColumn("_dim", F.size("_vector")).join(parts, ["_label", "_dim", "_deal", "_cell"])
    own = F.pmod(F.xxhash64("_node", F.lit(5)), F.col("_parts"))
    met = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1), lambda x: F.struct(
        F.least(x, own).alias("low"), F.greatest(x, own).alias("high"), F.when(own <= x, 0).otherwise(1).alias("side")))
    return rows.select(
        F.xxhash64("_label", "_dim", "_deal", "_cell").alias("_key"), "_label", "_dim", "_deal", "_cell", "_node", "_cells",
        "_size", "_vector", F.explode(met).alias("_met"),
    ).select("*", F.col("_met.low").alias("_low"), F.col("_met.high").alias("_high"), F.col("_met.side").alias("_side")).drop("_met")


def _blocks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that agree in the first columns ``keys``, which come together."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for name in keys:
            column = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
            change[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(change).tolist()
        if kept and any(kept[-1].column(n)[-1] != batch.column(n)[0] for n in keys):
            yield pa.Table.from_batches(kept)
            kept = []
        for at, to in zip([0, *starts], [*starts, batch.num_rows]):
            if at:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(at, to - at))
    if kept:
        yield pa.Table.from_batches(kept)


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each member's component."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = np.minimum(root, root[root])
        if (root == before).all():
            return root


def _searched(tiles: DataFrame, cosine: float) -> DataFrame:
    """``node, links, other``: weights linked to the node there, and a node of its component there."""
    keys = ["_key", "_label", "_dim", "_deal", "_cell", "_low", "_high"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, keys):
            n = block.num_rows
            if n < 2:
                continue
            found = _linked(block.combine_chunks(), cosine)
            if found is not None:
                nodes, links, roots = found
                yield pa.RecordBatch.from_arrays([nodes, pa.array(links), roots], names=["node", "links", "other"])

    dealt = tiles.repartition(*keys).sortWithinPartitions(*keys, "_side")
    return dealt.mapInArrow(search, "node string, links long, other string")


def _linked(block: pa.Table, cosine: float) -> tuple[pa.Array, np.ndarray, pa.Array] | None:
    n, dim, deal = block.num_rows, block["_dim"][0].as_py(), block["_deal"][0].as_py()
    column = lambda name: block[name].combine_chunks()
    vectors = column("_vector").flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
    at = column("_cells").flatten().to_numpy().reshape(n, -1)
    weight = column("_size").to_numpy()
    first = int((column("_side").to_numpy() == 0).sum())
    alone = block["_low"][0] == block["_high"][0]
    unit = units(vectors)
    rule: Calibration = calibrated(dim, cosine)
    links, ends = np.zeros(n, np.int64), []
    for a, b in candidates(unit, n if alone else first, 0 if alone else first, rule):
        met = np.zeros(len(a), bool)
        for earlier in range(deal):
            met |= at[a, earlier] == at[b, earlier]
        a, b = a[~met], b[~met]
        near = verified(vectors, a, b, cosine)
        a, b = a[near], b[near]
        links += np.bincount(a, weight[b], n).astype(np.int64) + np.bincount(b, weight[a], n).astype(np.int64)
        ends.append((a, b))
    if not links.any():
        return None
    root = _spanning(n, *(np.concatenate(x) for x in zip(*ends)))
    seen = np.flatnonzero(links)
    node = column("_node")
    return node.take(pa.array(seen)), links[seen], node.take(pa.array(root[seen]))


def verified(vectors: np.ndarray, a: np.ndarray, b: np.ndarray, cosine: float, block: int = 1 << 14) -> np.ndarray:
    """Which pairs have the cosine, in double precision."""
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    out = np.zeros(len(a), bool)
    for at in range(0, len(a), block):
        x, y = a[at : at + block], b[at : at + block]
        out[at : at + block] = (vectors[x] * vectors[y]).sum(axis=1) >= cosine * (lengths[x] * lengths[y])
    return out


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    tile: int = TILE,
) -> DataFrame:
    """``id_col, n_links`` (other rows linked), ``component_id`` (least id reachable)
    and ``kept`` (the row's id is that) of every row.

    Rows link when their labels and lengths are equal and their cosine is at
    least ``cosine``. Rows without a label, and vectors that are null, empty or
    zero or hold null or non-finite numbers, link with nothing. Repeated rows
    are rows of their own and link with each other; a null id counts as greater
    than any other. Other columns are not read; an empty table gives an empty
    result. All links stated are true; some ``MISSED`` of those at just the
    least cosine may be passed over, fewer above it.
    """
    rows = vectors.select(
        F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).cast(_DOUBLES).alias("_vector")
    )
    rows = rows.withColumn("_node", F.when(_usable("_vector", "_label"), F.concat(
        F.hex(F.xxhash64("_label", "_vector")), F.hex(F.xxhash64(F.lit(3), "_vector", "_label")))))
    grouped = rows.filter("_node IS NOT NULL").groupBy("_node", "_label").agg(
        F.first("_vector").alias("_vector"), F.count("*").alias("_size"), F.min("_id").alias("_least"))
    classes = written(grouped.withColumn("_dim", F.size("_vector")), "vectors")
    dealt = written(_dealt(classes, cosine), "dealt")
    found = written(_searched(_tiles(dealt, tile), cosine), "links")
    joined = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    judged = classes.join(joined, classes["_node"] == joined["node"], "left").drop("node").join(counts, F.col("_node") == F.col("node"), "left").drop("node")
    judged = judged.withColumn("component", F.coalesce("component", "_node"))
    least = judged.groupBy("component").agg(F.min("_least").alias("_component_id"))
    judged = judged.join(least, "component").select(
        "_node", (F.coalesce("links", F.lit(0)) + F.col("_size") - 1).alias("_links"), "_component_id")
    return rows.select("_id", "_node").join(judged, "_node", "left").select(
        F.col("_id").alias(id_col), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("_links").isNull(), F.col("_id")).otherwise(F.col("_component_id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
