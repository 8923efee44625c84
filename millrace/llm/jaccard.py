"""Exact Jaccard self-join on word shingles, with components.

1. Hashed shingles are dealt to groups that cut the hash range evenly. A linked
   pair differs in at most ``t`` shingles (``t`` follows from the sizes), so of
   ``t + 1`` groups one is the same in both: documents that agree in no group
   cannot link. Agreeing documents form a block.
2. Each document pairs with one partner: of the least documents of its blocks
   the one it shares most blocks with. The count vectors of a pair bound its
   overlap, and pairs that survive are verified on whole texts. Verified links
   give first components. This is repeated a few times among documents of
   different components, with other partners, so that groups of many copies
   grow together before any block is searched whole.
3. Sets that open blocks (those that still hold several components) connect
   travel to one place, or block by block where there are too many. There an
   R-tree over the count vectors proposes pairs of different components, exact
   sets verify them, and only links that join two components leave the task:
   fewer than the sets that came in, however many pairs link.

No link is lost: a linked pair shares a block, and there it is in one component
after step 2 or is found in step 3.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.count_tree import CountTree, reachable
from millrace.llm.graph import components
from millrace.llm.rows import attach
from millrace.session import written

GROUPS = 128
CLASS_RATIO = 1.4
#: Documents of a size class that may need keys for empty groups, at most.
RARE = 1e-5
HOT_SHARE, HOT_LEAST, SAMPLE = 200_000, 100, 16
#: Sets and shingles of a tile, two of which a task holds at a time.
TILE, TILE_SHINGLES = 4096, 1 << 22
PER_LEADER = 512
ROUNDS = 2
CACHED_WORDS = 1 << 18

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the 64-bit result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct hashed shingles of a text given as UTF-8 bytes."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.odd = _mix(np.arange(1, words + 1, dtype=np.uint64) * _ODD[0]) | np.uint64(1)
        self._hashes: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        known = self._hashes.get(word)
        if known is None:
            if len(self._hashes) >= CACHED_WORDS:
                self._hashes.clear()
            known = self._hashes[word] = xxhash.xxh3_64_intdigest(word)
        return known

    def __call__(self, text: bytes) -> np.ndarray:
        """Sorted 64-bit hashes; a text shorter than a shingle counts as one."""
        words = text.translate(_LOWER).split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self._hash, words), np.uint64, len(words))
        take = min(self.words, len(words))
        sums = np.full(len(words) - take + 1, take, np.uint64)
        for i in range(take):
            sums += hashes[i : len(hashes) - take + 1 + i] * self.odd[i]
        return np.unique(_mix(sums))


def differing(size: int, percent: int) -> int:
    """Most elements in which a set of this size can differ from a linked one that is not smaller."""
    return size * (100 - percent) // percent


@lru_cache
def size_class(number: int, percent: int) -> tuple[int, int, int, int]:
    """``least, most, groups, spare`` of a class of set sizes.

    ``groups`` is one more than the differing elements plus ``spare``. A set
    with at most ``spare`` empty groups is sure to agree with a linked one in a
    group that is not empty; only sets with more need keys for empty groups.
    """
    least = 1
    for _ in range(number):
        least = int(least * CLASS_RATIO) + 1
    most = int(least * CLASS_RATIO)
    needed = differing(most, percent) + 1
    for spare in range(most + 1):
        groups, empty = needed + spare, spare + 1
        if empty >= groups:
            break
        chance = math.lgamma(groups + 1) - math.lgamma(empty + 1) - math.lgamma(groups - empty + 1)
        if chance + least * math.log1p(-empty / groups) < math.log(RARE):
            break
    return least, most, needed + spare, spare


def class_of(size: int, percent: int) -> int:
    number = 0
    while size_class(number, percent)[1] < size:
        number += 1
    return number


def block_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the blocks of a set; linked sets that differ share one.

    A pair uses the groups of its smaller set's class, so a set that may be the
    larger one of a pair across classes has keys in the class below as well.
    """
    size, out = len(shingles), [np.empty(0, np.uint64)]
    number = class_of(size, percent) if size else 0
    for c in range(number, -1, -1):
        _, most, groups, spare = size_class(c, percent)
        if c < number and size > most * 100 // percent:
            break
        if differing(most, percent) == 0:
            continue
        group = ((shingles >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)
        starts = np.flatnonzero(np.diff(group, prepend=np.uint64(groups)))
        label = np.uint64(c << 32) + group[starts]
        out.append(_mix(np.add.reduceat(shingles, starts) + _mix(label * _ODD[1])))
        if groups - len(starts) > spare:
            empty = np.setdiff1d(np.arange(groups, dtype=np.uint64), group[starts])
            out.append(_mix(_mix((np.uint64(c << 32) + empty) * _ODD[2])))
    return np.concatenate(out)


def count_vector(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall in each hash group."""
    return np.bincount(shingles >> np.uint64(64 - GROUPS.bit_length() + 1), minlength=GROUPS)


def group_counts(shingles: np.ndarray) -> bytes:
    """The count vector in as many bytes a group as its greatest count needs."""
    counts = count_vector(shingles)
    return counts.astype(np.min_scalar_type(counts.max()).newbyteorder("<")).tobytes()


def _unpacked(counts: list[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(c, f"<u{len(c) // GROUPS}") for c in counts], np.int64).reshape(-1, GROUPS)


_ROWS = "key long, set_id long, doc_id {kind}, n_shingles long, text_key long, counts binary"


def _blocks(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """A row per document (``n_shingles`` set) and a row per block key of each set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(words), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                keys, owners, sets, sizes, counts = [], [], [], [], []
                for text in part.column(1).to_pylist():
                    shingles = shingler(text)
                    digest = xxhash.xxh3_64_intdigest(shingles.tobytes())
                    sizes.append(len(shingles))
                    sets.append(digest)
                    counts.append(group_counts(shingles))
                    if digest not in seen:
                        seen.add(digest)
                        own = block_keys(shingles, percent)
                        keys.append(own)
                        owners.append(np.full(len(own), digest, np.uint64))
                ids = np.array(sets, np.uint64)
                spread = _mix(ids + np.arange(at, at + len(ids), dtype=np.uint64) * _ODD[3])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(spread.view(np.int64)), pa.array(ids.view(np.int64)), part.column(0),
                        pa.array(sizes, pa.int64()), part.column(2), pa.array(counts, pa.binary()),
                    ],
                    names=["key", "set_id", "doc_id", "n_shingles", "text_key", "counts"],
                )
                if keys:
                    flat, owner = np.concatenate(keys), np.concatenate(owners)
                    empty = [pa.nulls(len(flat), t) for t in (part.column(0).type, pa.int64(), pa.int64(), pa.binary())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(flat.view(np.int64)), pa.array(owner.view(np.int64)), *empty],
                        names=["key", "set_id", "doc_id", "n_shingles", "text_key", "counts"],
                    )

    return docs.mapInArrow(rows, _ROWS.format(kind=kind))


def _hot_keys(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Keys that very many sets share, with how many ways to split them.

    Judged on every 16th document; only the layout depends on it, never a
    result. A key counts as hot from 1 / 200,000 of the rows on, so the list
    has at most 200,000 entries and may be broadcast.
    """
    some = docs.filter(F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SAMPLE)) == 0)
    counts = written(
        _blocks(some, words, percent).filter("n_shingles IS NULL").groupBy("key").count()
        .filter(F.col("count") >= HOT_LEAST), "key-counts",
    )
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.filter(F.col("count") >= F.lit(total / HOT_SHARE))
    return hot.select("key", F.ceil(F.col("count") / HOT_LEAST).cast("long").alias("ways"))


def _counted(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose count vectors allow enough overlap."""
    a = sets.select(F.col("set_id").alias("a"), F.col("counts").alias("counts_a"))
    b = sets.select(F.col("set_id").alias("b"), F.col("counts").alias("counts_b"))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_unpacked(batch.column(i).to_pylist()) for i in (2, 3))
            sizes = left.sum(axis=1) + right.sum(axis=1)
            shared = np.minimum(left, right).sum(axis=1)
            keep = reachable(shared, sizes, 0, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    joined = pairs.join(b, "b").join(a, "a").select("a", "b", "counts_a", "counts_b")
    return joined.mapInArrow(bounded, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that link, judged on whole texts.

    Partners of one set travel to it. A set with many partners is copied to one
    place per 512 of them, so no place gathers an unbounded group.
    """
    ways = pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_LEADER).cast("long").alias("ways"))
    partner = pairs.join(ways, "a").select(
        "a", F.pmod(F.xxhash64("b"), "ways").alias("way"), F.lit(1).alias("role"), F.col("b").alias("set_id")
    )
    leader = ways.select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ways") - 1)).alias("way"), F.lit(0).alias("role"),
        F.col("a").alias("set_id"),
    )
    places = leader.unionByName(partner).join(sets.select("set_id", "doc_id", "text_key"), "set_id")
    texts = docs.withColumnRenamed("doc_id", "own_id").withColumnRenamed("text_key", "own_key")
    moved = texts.join(
        places, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key"))
    ).select("a", "way", "role", "set_id", "text")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, own = Shingler(words), None, np.empty(0, np.uint64)
        for batch in batches:
            found = []
            for a, role, b, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if role == 0:
                    if held != a:
                        held, own = a, shingler(text)
                    continue
                other = shingler(text)
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(other) - both):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    ordered = moved.repartition("a", "way").sortWithinPartitions("a", "way", "role")
    return ordered.mapInArrow(judged, "a long, b long")


def _open_blocks(members: DataFrame, first: DataFrame) -> DataFrame:
    """``key, leader, set_id, component`` of the blocks that hold several
    components; of blocks with the same sets, one."""
    labelled = members.select("key", "set_id").distinct().join(
        first.withColumnRenamed("node", "set_id"), "set_id", "left"
    ).select("key", "set_id", F.coalesce("component", "set_id").alias("component"))
    labelled = written(labelled, "labelled")
    blocks = labelled.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("set_id").alias("leader"),
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("set_id")).alias("sum_1"),
        F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("sum_2"),
    ).filter("low < high")
    distinct = blocks.groupBy("leader", "size", "sum_1", "sum_2").agg(F.min("key").alias("key"))
    return labelled.join(distinct.select("key", "leader"), "key")


def _partners(blocks: DataFrame, turn: int) -> DataFrame:
    """At most four pairs per set: of the sets that lead its open blocks this
    turn and are of another component, those it shares most blocks with."""
    leads = blocks.groupBy("key").agg(
        F.min_by(F.struct("set_id", "component"), F.xxhash64("set_id", F.lit(turn))).alias("lead")
    )
    best = (
        blocks.join(leads, "key").filter(F.col("component") != F.col("lead.component"))
        .groupBy("set_id", F.col("lead.set_id").alias("partner")).count()
        .groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("count", "partner")), False).alias("best"))
        .select("set_id", F.explode(F.slice("best", 1, 4)).alias("best"))
    )
    return best.select(
        F.least("set_id", "best.partner").alias("a"), F.greatest("set_id", "best.partner").alias("b")
    ).distinct()


def _places(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    """``place, low, high, side, set_id, component``: where open sets meet.

    Sets that blocks connect meet in one place if they fit a tile, or if
    comparing them all is no more work than comparing each block; otherwise
    each block is a place. A place too large for a tile is cut into tiles, and
    each pair of tiles meets on its own.
    """
    together = components(blocks.select(F.col("leader").alias("a"), F.col("set_id").alias("b")))
    members = written(
        blocks.select("key", "set_id", "component")
        .join(together.select(F.col("node").alias("set_id"), F.col("component").alias("whole")), "set_id")
        .join(sets.select("set_id", "n_shingles"), "set_id"),
        "members",
    )
    size = [F.count("*").alias("sets"), F.sum("n_shingles").alias("shingles")]
    by_block = members.groupBy("key", "whole").agg(*size)
    work = by_block.groupBy("whole").agg(F.sum(F.col("sets").cast("double") * F.col("sets")).alias("work"))
    by_whole = members.select("whole", "set_id", "n_shingles").distinct().groupBy("whole").agg(*size).join(work, "whole")
    fits = (F.col("sets") <= TILE) & (F.col("shingles") <= TILE_SHINGLES)
    cheaper = F.col("sets").cast("double") * F.col("sets") <= F.col("work")
    by_whole = by_whole.withColumn("as_whole", fits | cheaper)
    tiles = F.ceil(F.greatest(F.col("sets") / TILE, F.col("shingles") / TILE_SHINGLES)).cast("int").alias("tiles")
    wholes = by_whole.filter("as_whole").select("whole", tiles)
    parts = by_block.join(by_whole.filter("NOT as_whole").select("whole"), "whole").select("key", tiles)
    met = (
        members.select("whole", "set_id", "component").distinct().join(wholes, "whole")
        .select(F.col("whole").alias("place"), "tiles", "set_id", "component")
        .unionByName(members.join(parts, "key").select(F.col("key").alias("place"), "tiles", "set_id", "component"))
    )
    return (
        met.withColumn("own", F.pmod(F.hash("set_id"), "tiles"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "place", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            (F.col("own") > F.col("other")).cast("int").alias("side"), "set_id", "component",
        )
    )


def joining_links(
    sets: list[np.ndarray], component: np.ndarray, first: np.ndarray, second: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Positions of linked sets, one of ``first`` and one of ``second``, that join
    what neither ``component`` nor an earlier link has joined.

    The R-tree over the count vectors of ``first`` proposes, the shingles decide.
    """
    if not len(first) or not len(second):
        return []
    sizes = np.array([len(x) for x in sets])
    starts = np.cumsum(sizes) - sizes
    distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
    counts = np.array([count_vector(x) for x in sets])
    tree, root, out = CountTree(counts[first]), component.copy(), []
    own = np.zeros(len(distinct), bool)
    for q in second:
        hits = first[tree.search(counts[q], percent)]
        hits = hits[root[hits] != root[q]]
        if not len(hits):
            continue
        mine = flat[starts[q] : starts[q] + sizes[q]]
        own[mine] = True
        ends = np.cumsum(sizes[hits])
        at = np.arange(ends[-1]) + np.repeat(starts[hits] - ends + sizes[hits], sizes[hits])
        both = np.add.reduceat(own[flat[at]].astype(np.int64), ends - sizes[hits])
        own[mine] = False
        for hit in hits[reachable(both, sizes[hits], int(sizes[q]), percent)]:
            if root[hit] != root[q]:
                root[root == root[hit]] = root[q]
                out.append((int(hit), int(q)))
    return out


def _between_components(
    blocks: DataFrame, sets: DataFrame, docs: DataFrame, words: int, percent: int
) -> DataFrame:
    """Links between different components of open blocks: enough of them to join
    all that links join, at most one fewer than a place has sets.

    ``blocks``: ``key, leader, set_id, component``. Texts travel to the places
    of their sets, once each where sets meet as a whole.
    """
    places = _places(blocks, sets).join(sets.select("set_id", "doc_id", "text_key"), "set_id")
    texts = docs.withColumnRenamed("doc_id", "own_id").withColumnRenamed("text_key", "own_key")
    moved = texts.join(
        places, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key"))
    ).select("place", "low", "high", "side", "component", "set_id", "text")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, place, held = Shingler(words), None, {}

        def flush() -> pa.RecordBatch:
            sides = np.array([h[0] for h in held.values()])
            component = np.array([h[1] for h in held.values()], np.int64)
            first = np.flatnonzero(sides == 0)
            second = first if place[1] == place[2] else np.flatnonzero(sides == 1)
            ids = list(held)
            found = joining_links([h[2] for h in held.values()], component, first, second, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[p[i]] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            for *here, side, component, set_id, text in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if here != place:
                    if held:
                        yield flush()
                    place, held = here, {}
                # A document that occurs twice brings its set twice.
                if set_id not in held:
                    held[set_id] = (side, component, shingler(text))
        if held:
            yield flush()

    ordered = moved.repartition("place", "low", "high").sortWithinPartitions("place", "low", "high", "set_id")
    return ordered.mapInArrow(searched, "a long, b long")


def linked_documents(
    docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_shingles, component_id`` of every row.

    Texts are lower-cased in A-Z and cut into words at white space; a set holds
    the distinct shingles of ``words`` words, or the whole text when it is
    shorter. Two rows link when ``100 * intersection >= percent * union``; the
    component is the least id reachable. A null or empty text has no shingles,
    links with nothing and is its own component. Equal texts always link;
    repeated and null ids are rows like others (a component of null ids only is
    null). Other columns are not read; an empty table gives an empty result.

    Shingles and sets are told apart by 64-bit hashes.
    """
    return _linked(docs, words, percent, id_col, text_col).drop("text_key").withColumnRenamed("doc_id", id_col)


def _linked(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    hot = F.broadcast(_hot_keys(rows, words, percent))
    in_block, in_part = Window.partitionBy("key"), Window.partitionBy("key", "part")
    dealt = _blocks(rows, words, percent).join(hot, "key", "left").withColumn(
        "part", F.when(F.col("ways").isNull(), 0).otherwise(F.pmod(F.hash("set_id"), F.col("ways")))
    )
    found = written(
        dealt.withColumn("leader", F.min("set_id").over(in_part)).withColumn("last", F.max("set_id").over(in_part))
        .filter("n_shingles IS NOT NULL OR leader < last OR ways IS NOT NULL").drop("part", "last"),
        "blocks",
    )
    members = found.filter("n_shingles IS NULL").select("key", "set_id", "leader", "ways")
    owners = found.filter("n_shingles IS NOT NULL").select("doc_id", "set_id", "n_shingles", "text_key", "counts")
    sets = written(
        owners.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_key", "counts", "n_shingles")).alias("own"))
        .select("set_id", "own.*"),
        "sets",
    )
    parts = members.filter("ways IS NOT NULL").select("key", F.col("leader").alias("set_id")).distinct()
    between = parts.withColumn("leader", F.min("set_id").over(in_block)).select("set_id", "leader")
    partners = (
        members.select("set_id", "leader").unionByName(between).filter("leader <> set_id")
        .groupBy("set_id", "leader").count()
        .groupBy("set_id").agg(F.max(F.struct("count", "leader")).alias("best"))
    )
    pairs = partners.select(
        F.least("set_id", "best.leader").alias("a"), F.greatest("set_id", "best.leader").alias("b")
    ).distinct()
    judged = written(_counted(pairs, sets, percent), "judged")
    links = written(_verified(judged, sets, rows, words, percent), "links")
    first = written(components(links), "components")
    blocks = _open_blocks(members, first)
    for turn in range(1, ROUNDS):
        pairs = _partners(blocks, turn).join(judged, ["a", "b"], "left_anti")
        pairs = written(_counted(pairs, sets, percent), "judged")
        judged = judged.unionByName(pairs)
        more = written(_verified(pairs, sets, rows, words, percent), "links")
        if more.isEmpty():
            break
        links = links.unionByName(more)
        first = written(components(links), "components")
        blocks = _open_blocks(members, first)
    more = written(_between_components(blocks, sets, rows, words, percent), "links")
    if not more.isEmpty():
        first = written(components(links.unionByName(more)), "components")
    grouped = owners.filter("n_shingles > 0").join(
        first.withColumnRenamed("node", "set_id"), "set_id", "left"
    ).withColumn("component", F.coalesce("component", "set_id"))
    least = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    columns = ["doc_id", "n_shingles", "component_id", "text_key"]
    linked = grouped.join(least, "component").select(columns)
    alone = owners.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id")).select(columns)
    return linked.unionByName(alone)


def one_of_each(
    docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component, the one with the least id.

    Rows without shingles all stay. Of rows that share the least id, one stays;
    in a component of null ids only, all do.
    """
    first = F.row_number().over(Window.partitionBy("component_id", "doc_id").orderBy("n_shingles", "text_key"))
    stays = (F.col("n_shingles") == 0) | F.col("component_id").isNull() | (
        (F.col("doc_id") == F.col("component_id")) & (first == 1)
    )
    decided = _linked(docs, words, percent, id_col, text_col).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.coalesce(stays, F.lit(False)).alias("__stays")
    )
    keys = {"__id": F.col(id_col), "__key": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))}
    return attach(docs, decided, keys, ["__stays"]).filter("__stays").select(docs.columns)
