"""Sharding by histogram sort.

Documents are ordered by a hash of their text, then of their id, then by where
they are stored, so equal texts lie together and even equal rows can be parted. The cuts between shards are found without sorting: bytes below
candidate keys are counted exactly over all partitions, and the range around
each cut is probed again, finer, until the bytes below a probe are within
tolerance of the wanted amount. Only then is anything exchanged, once.
Everything is built-in expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import ranked, text_or_empty
from millrace.session import written

#: Hash keys are 63 bits wide, so that differences of two never overflow.
KEYS = 1 << 63


@dataclass(frozen=True)
class Cut:
    """Rows whose (text_key, id_key, copy_key) is not less than the cut's lie above it."""

    text_key: int
    id_key: int = 0
    copy_key: int = 0


@dataclass(frozen=True)
class _Search:
    """Where a cut is still sought: [low, low + width) of one key, and the bytes below low."""

    wanted: float
    low: int = 0
    width: int = KEYS
    below: int = 0
    text_key: int | None = None
    id_key: int | None = None

    @property
    def place(self) -> tuple:
        return self.text_key, self.id_key, self.low, self.width

    def step(self, probes: int) -> int:
        return -(-self.width // probes)

    def cut(self, at: int) -> Cut:
        return Cut(*[k for k in (self.text_key, self.id_key) if k is not None], at)


def _keys(id_col: str, text_col: str) -> list[Column]:
    return [
        F.shiftrightunsigned(F.xxhash64(text_or_empty(text_col)), 1).alias("text_key"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 1).alias("id_key"),
    ]


def sized_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: id, size in bytes plus 1, CRC-32 and keys.

    ``copy_key`` tells rows apart that agree in text and id.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty(text_col)).alias("text_crc32"),
        *_keys(id_col, text_col),
        F.monotonically_increasing_id().alias("copy_key"),
    )


def find_cuts(keyed: DataFrame, shards: int = 8, tolerance: float = 0.005, probes: int = 512) -> list[Cut]:
    """``shards - 1`` cuts whose bytes below miss equal parts by at most
    ``tolerance`` of a shard.

    A cut falls between texts; only where one text's copies alone exceed the
    tolerance does it fall between ids of that text, and between rows of one id
    only where these alone exceed it. The driver receives at most
    ``(shards - 1) * probes`` counts a round, and a round narrows each range
    ``probes``-fold, so at most 21 rounds are needed, two or three as a rule.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    open_ = {n: _Search(total * n / shards) for n in range(1, shards)}
    cuts: dict[int, Cut] = {}
    while open_:
        places = sorted({s.place for s in open_.values()}, key=str)
        counted = _bytes_by_probe(keyed, places, probes)
        narrowed = {}
        for n, search in open_.items():
            sums = counted.get(places.index(search.place), {})
            found = _narrow(search, sums, slack, probes)
            if isinstance(found, Cut):
                cuts[n] = found
            else:
                narrowed[n] = found
        open_ = narrowed
    return [cuts[n] for n in sorted(cuts)]


def _bytes_by_probe(keyed: DataFrame, places: list[tuple], probes: int) -> dict[int, dict[int, int]]:
    """Bytes of the rows between neighbouring probes, for each range."""
    which, probe = F.lit(None).cast("int"), F.lit(None).cast("long")
    for n, (text_key, id_key, low, width) in enumerate(places):
        fixed = {k: v for k, v in (("text_key", text_key), ("id_key", id_key)) if v is not None}
        key = F.col(("text_key", "id_key", "copy_key")[len(fixed)])
        inside = (key >= low) & (key <= low + width - 1)
        for name, value in fixed.items():
            inside = inside & (F.col(name) == value)
        offset = F.call_function("div", key - F.lit(low), F.lit(-(-width // probes)))
        which, probe = F.when(inside, n).otherwise(which), F.when(inside, offset).otherwise(probe)
    rows = (
        keyed.select(which.alias("which"), probe.alias("probe"), "size")
        .filter("which IS NOT NULL").groupBy("which", "probe").agg(F.sum("size").alias("size")).collect()
    )
    out: dict[int, dict[int, int]] = {}
    for row in rows:
        out.setdefault(row["which"], {})[row["probe"]] = row["size"]
    return out


def _narrow(search: _Search, sums: dict[int, int], slack: float, probes: int) -> Cut | _Search:
    step, below = search.step(probes), search.below
    for probe in sorted(sums):
        above = below + sums[probe]
        if above >= search.wanted:
            break
        below = above
    else:
        return search.cut(search.low + search.width)
    low = search.low + probe * step
    width = min(step, search.low + search.width - low)
    near, miss = min(((low, search.wanted - below), (low + width, above - search.wanted)), key=lambda x: x[1])
    # Equal rows are counted to the end: how many lie below must not depend on where they are stored.
    if miss <= slack and search.id_key is None:
        return search.cut(near)
    inner = replace(search, low=low, width=width, below=below)
    if width > 1:
        return inner
    if search.text_key is None:
        return replace(inner, text_key=low, low=0, width=KEYS)
    if search.id_key is None:
        return replace(inner, id_key=low, low=0, width=KEYS)
    return search.cut(near)


def shard_of(cuts: list[Cut], names: dict[str, str] | None = None) -> Column:
    """Shard number over the columns ``text_key``, ``id_key`` and ``copy_key``, or what ``names`` calls them."""
    names = names or {}
    shard = F.lit(0)
    for cut in cuts:
        above = F.lit(True)
        for name in ("copy_key", "id_key", "text_key"):
            value = getattr(cut, name)
            key = F.col(names.get(name, name))
            above = (key > value) | ((key == value) & above) if value < KEYS else F.lit(False)
        shard = shard + above.cast("int")
    return shard


def assign_shards(
    docs: DataFrame, shards: int = 8, tolerance: float = 0.005, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Shard and slot of every document, under the law ``bytes``.

    Sizes (UTF-8 bytes plus 1) of the shards come out near equal; copies of one
    text share a shard unless that would miss the tolerance. Slots run from 0
    within a shard in key order. A null text has size 1 and the CRC-32 of an
    empty one. Null and repeated ids are rows like others, and rows that agree
    in text and id are parted where the law asks for it; extra columns are not read. An empty table gives an empty result.
    """
    keyed = written(sized_keys(docs, id_col, text_col), "keys")
    placed = keyed.withColumn("shard", shard_of(find_cuts(keyed, shards, tolerance)))
    order = [F.asc("text_key"), F.asc("id_key"), F.asc("text_crc32"), F.asc("size"), F.asc("doc_id"), F.asc("copy_key")]
    return ranked(placed, ["shard"], order, "slot").select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = 8, tolerance: float = 0.005, id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write whole documents under ``path/shard=N``, in key order, all columns kept.

    A row's shard follows from its keys alone, so the documents themselves are
    exchanged once, by ranges that also split a hot text. Only where rows that
    agree in text and id must be parted are they written once before, so that
    each keeps its place. If ``docs`` has a column ``shard``, the folders are
    called ``shard_1=N``, or by the next free number.
    """
    taken = {c.lower() for c in docs.columns}
    home = next(n for n in ("shard", *(f"shard_{i}" for i in range(1, len(taken) + 2))) if n not in taken)
    names = {k: f"__{k}" for k in ("text_key", "id_key", "copy_key")}
    own = dict(zip(("text_key", "id_key"), _keys(id_col, text_col), strict=True))
    size = sized_keys(docs.select(id_col, text_col), id_col, text_col)
    cuts = find_cuts(written(size, "keys"), shards, tolerance)
    keyed = docs.withColumns({names[k]: c for k, c in own.items()}).withColumn(names["copy_key"], F.monotonically_increasing_id())
    if any(cut.copy_key for cut in cuts):
        keyed = written(keyed, "keyed")
        sizes = (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size")
        cuts = find_cuts(keyed.select(sizes, *[F.col(v).alias(k) for k, v in names.items()]), shards, tolerance)
    order = [home, *names.values()]
    (
        keyed.withColumn(home, shard_of(cuts, names))
        .repartitionByRange(*order).sortWithinPartitions(*order).drop(*names.values())
        .write.partitionBy(home).parquet(path)
    )
