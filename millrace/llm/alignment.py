"""Which tokens of two tokenizers cover the same bytes.

A token-byte incidence matrix has a row per token and a column per byte of the
text, with a space before it. The rows of ``A @ B.T`` are the B tokens that
share bytes with an A token: the overlap links. Offsets where a token of both
ends cut the tokens into groups; the product of the group incidences links the
tokens of a group. Several documents form one block matrix, so the products
run over about a megabyte at a time.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.bpe import PRE_TOKEN, byte_symbols
from millrace.llm.csr import Csr, product
from millrace.session import written

#: Characters of a text that are encoded at once, and of texts that share a matrix.
PART = LOT = 1 << 18
#: Rows of the pair table up to which it is sent to every executor (about 50 MB).
SENT_PAIRS = 1 << 20
_BITS = 20
_WORDS = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: Runs of blanks at which the faster encoder's pattern would run out of stack.
_BLANKS = 4096
_BLANK_RUN = re.compile(r"\s{%d}" % _BLANKS)


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a_spec: str, b_model: bytes) -> None:
        import sentencepiece
        import tiktoken
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_spec)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        names = {i: token for token, i in self.a.get_vocab(with_added_tokens=True).items()}
        own = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [
            bytes(byte_of[c] for c in token) if token in own and all(c in byte_of for c in token) else token.encode()
            for token in (names.get(i, "") for i in range(max(names) + 1))
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        # The same vocabulary as ranks, for an encoder that keeps only ids.
        special = set(self.a.get_added_tokens_decoder())
        ranks = {x: i for i, x in enumerate(self.a_bytes) if i not in special and x}
        self.fast = tiktoken.Encoding("a", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        if max(len(self.a_bytes), len(self.b_bytes)) >> _BITS:
            raise ValueError(f"ids must have at most {_BITS} bits")
        # No token reaches over a space between two letters, so both tokenizers may start anew there.
        self.cuttable = not any(re.search(rb"[A-Za-z] ", x) for x in self.a_bytes + self.b_bytes)
        self.a_text = [[b"%d%s" % (i, s) for i in range(len(self.a_bytes))] for s in (b",", b"|")]
        self.b_text = [[b"%d%s" % (i, s) for i in range(len(self.b_bytes))] for s in (b",", b";")]

    def parts(self, text: str) -> list[str]:
        """Parts of a long text that are encoded by themselves, each with the space before it."""
        out, at = [], 0
        while self.cuttable and len(text) - at > PART and (cut := _WORDS.search(text, at + PART)):
            out.append(text[at : cut.start()])
            at = cut.end()
        return [*out, text[at:]]

    def encode(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both tokenizers for each part; None where they don't give its bytes."""
        for part, b in zip(parts, self.b.encode(parts, num_threads=1)):
            raw = " " + part
            if len(raw) >= _BLANKS and _BLANK_RUN.search(raw):
                a = self.a.encode(raw, add_special_tokens=False).ids
            else:
                a = self.fast(raw)
            if b"".join(map(self.a_bytes.__getitem__, a)) == raw.encode() == b"".join(map(self.b_bytes.__getitem__, b)):
                yield np.array(a, np.int64), np.array(b, np.int64)
            else:
                yield None


@functools.lru_cache(maxsize=2)
def tokenizers_of(a_spec: str, b_model: bytes) -> Tokenizers:
    """One pair per worker process."""
    return Tokenizers(a_spec, b_model)


@dataclass(frozen=True)
class Matrices:
    """Incidence of the tokens of some texts, one after the other."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    #: End of each group, and the group of each token.
    ends: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, both: Tokenizers) -> Matrices:
        a_ends, b_ends = np.cumsum(both.a_length[a]), np.cumsum(both.b_length[b])
        ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        return cls(a, b, a_ends, b_ends, ends, np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends))

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of A and B tokens that share bytes, and how many."""
        return product(Csr.runs(self.a_ends), Csr.runs(self.b_ends).transposed())

    def shared_groups(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of A and B tokens of one group."""
        groups = len(self.ends)
        return product(Csr.members(self.a_group, groups), Csr.members(self.b_group, groups).transposed())

    def written_groups(self, both: Tokenizers) -> bytes:
        """``a1,a2|b1;a3|b2,b3;`` of all groups."""
        last = lambda group: np.concatenate((group[1:] != group[:-1], [True])).tolist()
        a = [both.a_text[end][i] for i, end in zip(self.a.tolist(), last(self.a_group))]
        b = [both.b_text[end][i] for i, end in zip(self.b.tolist(), last(self.b_group))]
        order = np.argsort(np.concatenate((2 * self.a_group, 2 * self.b_group + 1)), kind="stable")
        return b"".join(map((a + b).__getitem__, order.tolist()))


def _encoded(texts: list[str], both: Tokenizers) -> Iterator[tuple[int, Matrices]]:
    """Place of the text and matrices of a part of it; texts whose bytes differ give none."""
    def flush(lot: list[tuple[int, list[str]]]) -> Iterator[tuple[int, Matrices]]:
        ids = both.encode([p for _, parts in lot for p in parts])
        for place, parts in lot:
            found = [next(ids) for _ in parts]
            if all(f is not None for f in found):
                for a, b in found:
                    yield place, Matrices.of(a, b, both)

    lot, size = [], 0
    for place, text in enumerate(texts):
        if not text:
            continue
        lot.append((place, both.parts(text)))
        size += len(text)
        if size >= LOT:
            yield from flush(lot)
            lot, size = [], 0
    yield from flush(lot)


def _joined(parts: list[Matrices], both: Tokenizers) -> Matrices:
    return Matrices.of(np.concatenate([m.a for m in parts]), np.concatenate([m.b for m in parts]), both)


def _lots(parts: Iterator[tuple[int, Matrices]]) -> Iterator[tuple[list[int], list[Matrices]]]:
    places, lot, size = [], [], 0
    for place, m in parts:
        places.append(place)
        lot.append(m)
        size += int(m.ends[-1])
        if size >= LOT:
            yield places, lot
            places, lot, size = [], [], 0
    if lot:
        yield places, lot


def measured(texts: list[str], both: Tokenizers) -> dict[str, np.ndarray | pa.Array]:
    """Of each text: counts of tokens, groups and links, digest of the groups,
    and its different pairs of linked ids (``pairs``, how often in ``times``)."""
    n = len(texts)
    counts = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links", "n_shared")}
    digests: list = [None] * n
    text_of, keys, times = [], [], []
    for places, lot in _lots(_encoded(texts, both)):
        place = np.array(places)
        for m, at in zip(lot, places):
            mark = digests[at]
            if mark is None:
                digests[at] = mark = [hashlib.sha256(), b""]
            joined = mark[1] + m.written_groups(both)
            mark[0].update(joined[:-1])
            mark[1] = joined[-1:]
        whole = _joined(lot, both)
        of_a = np.repeat(place, [len(m.a) for m in lot])
        of_b = np.repeat(place, [len(m.b) for m in lot])
        of_group = np.repeat(place, [len(m.ends) for m in lot])
        counts["n_a"] += np.bincount(of_a, minlength=n)
        counts["n_b"] += np.bincount(of_b, minlength=n)
        counts["n_groups"] += np.bincount(of_group, minlength=n)
        sizes = np.bincount(whole.a_group, minlength=len(whole.ends)) * np.bincount(whole.b_group, minlength=len(whole.ends))
        counts["n_shared"] += np.bincount(of_group, sizes, n).astype(np.int64)
        for row, column, _ in whole.overlaps():
            text = of_a[row]
            counts["n_links"] += np.bincount(text, minlength=n)
            texts_, keys_, times_ = _summed(text, whole.a[row] << _BITS | whole.b[column], np.ones(len(row), np.int64))
            text_of.append(texts_)
            keys.append(keys_)
            times.append(times_)
    empty = np.zeros(0, np.int64)
    text, key, often = _summed(*(np.concatenate([empty, *x]) for x in (text_of, keys, times)))
    ends = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n)))).astype(np.int32)
    return {
        **counts, "groups_sha256": pa.array(["" if d is None else d[0].hexdigest() for d in digests], pa.string()),
        "pairs": pa.ListArray.from_arrays(ends, key), "times": pa.ListArray.from_arrays(ends, often.astype(np.int32)),
    }


def _summed(text: np.ndarray, key: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``often`` over equal (text, key), in that order."""
    if not len(key):
        return text, key, often
    order = np.lexsort((key, text))
    text, key, often = text[order], key[order], often[order]
    heads = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (key[1:] != key[:-1]))))
    return text[heads], key[heads], np.add.reduceat(often, heads)


def _mapped(
    docs: DataFrame, keys: list[str], text_col: str, a_path: str, b_path: str, schema: str,
    work: Callable[[pa.RecordBatch, list[str], Tokenizers], Iterator[pa.RecordBatch]],
) -> DataFrame:
    """``work`` over some rows at a time; the columns ``keys`` come first, the text is handed over beside them."""
    context = docs.sparkSession.sparkContext
    files = context.broadcast((Path(a_path).read_text(encoding="utf-8"), Path(b_path).read_bytes()))
    place = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers_of(*files.value)
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(place).cast(pa.large_binary())).to_numpy(zero_copy_only=False) + 1)
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + 4 * LOT, "right")))
                part = batch.slice(at, to - at)
                yield from work(part, part.column(place).to_pylist(), both)
                at = to

    rows = docs.select(*keys, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    own = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys)
    return rows.mapInArrow(run, f"{own}, {schema}")


COUNTS = "n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, pairs array<long>, times array<int>"


def links(
    docs: DataFrame, a_path: str, b_path: str, shared_group: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every link: ``id_col, a_place, b_place`` (of the tokens in their text, from 0),
    ``a_id, b_id`` and ``n_bytes``, the bytes that both cover.

    With ``shared_group`` the tokens of a group are linked instead, and
    ``n_bytes`` are those of the group. Texts without tokens have no rows.
    """
    def work(part: pa.RecordBatch, texts: list[str], both: Tokenizers) -> Iterator[pa.RecordBatch]:
        before: dict[int, tuple[int, int]] = {}
        for place, m in _encoded(texts, both):
            a_from, b_from = before.get(place, (0, 0))
            before[place] = a_from + len(m.a), b_from + len(m.b)
            for row, column, value in m.shared_groups() if shared_group else m.overlaps():
                if shared_group:
                    value = np.diff(m.ends, prepend=0)[m.a_group[row]]
                key = part.column(0).take(pa.array(np.full(len(row), place)))
                yield pa.RecordBatch.from_arrays(
                    [key, *map(pa.array, (row + a_from, column + b_from, m.a[row], m.b[column], value))],
                    names=[id_col, "a_place", "b_place", "a_id", "b_id", "n_bytes"],
                )

    return _mapped(docs, [id_col], text_col, a_path, b_path, "a_place long, b_place long, a_id long, b_id long, n_bytes long", work)


def aligned(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", sent_pairs: int = SENT_PAIRS,
) -> DataFrame:
    """Alignment of both tokenizers in each document, and how usual its links are.

    Columns: ``id_col, n_a, n_b`` (tokens), ``n_groups, n_links`` (overlap
    links), ``n_best`` (links whose pair of ids is held by most documents among
    the pairs of its A id), ``count_sum`` (documents that hold the pair, summed
    over links), ``groups_sha256, n_shared`` (links inside groups).

    Null and empty texts, and texts whose bytes one tokenizer changes, have no
    tokens: zeros and an empty digest. Null and repeated ids are rows of their
    own and count as documents; other columns are not read; an empty table
    gives an empty result. Long texts are encoded in parts that meet where no
    token can cross. A row's pairs and their counts meet in a join; the table
    of pairs is sent to the executors only if it has at most ``sent_pairs``
    rows, and is shuffled otherwise.
    """
    names = COUNTS.split(", ")

    def work(part: pa.RecordBatch, texts: list[str], both: Tokenizers) -> Iterator[pa.RecordBatch]:
        found = measured(texts, both)
        columns = [found[n.split(" ")[0]] for n in names]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), *(c if isinstance(c, pa.Array) else pa.array(c) for c in columns)],
            names=["_row", "_id", *(n.split(" ")[0] for n in names)],
        )

    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = written(_mapped(numbered, ["_row", "_id"], "_text", a_path, b_path, COUNTS, work), "alignment")
    counts = written(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")), "pairs")
    by_a = F.shiftright("pair", _BITS).alias("a")
    most = counts.groupBy(by_a).agg(F.max("docs").alias("most"))  # at most one row per A id
    judged = counts.select("pair", "docs", by_a).join(F.broadcast(most), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    if counts.count() <= sent_pairs:
        judged = F.broadcast(judged)
    held = rows.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("_row", "x.pairs", "x.times")
    sums = held.join(judged, held["pairs"] == judged["pair"]).groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast(T.LongType()).alias(c)
    return rows.join(sums, "_row", "left").select(
        F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256", "n_shared"
    )
