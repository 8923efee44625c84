"""Byte-level BPE encoding and decoding with a segment tree over pair ranks.

The leaves of the tree hold the merge rank of each adjacent pair of symbols and
every inner node the least rank below it. The root therefore names the next
merge, the leftmost way down its place; a merge changes three leaves and their
ancestors. A pre-token of n bytes takes O(n log n) steps, so junk without white
space costs no more per byte than prose. Spark deals the documents; a worker
keeps the encodings of the pre-tokens it met last.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from itertools import accumulate, chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pre-token pattern of byte-level BPE.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = 1 << 30
CACHED_PIECES = 1 << 19
ROWS = 256


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files.

    Bytes printable in Latin-1 stand for themselves, the others take the code
    points from 256 on, in order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary read from the text of its JSON file."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        ids, symbols = spec["model"]["vocab"], byte_symbols()
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.byte_ids = [ids[s] for s in symbols]
        self._of_bytes = bytes(self.byte_ids) if max(self.byte_ids) < 256 else None
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks: list[dict[int, int]] = [{} for _ in range(max(ids.values()) + 1)]
        for rank, (a, b) in enumerate(merges):
            self.ranks[ids[a]][ids[b]] = rank
        self.merged = [ids[a + b] for a, b in merges]
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.special = {}
        for token in spec.get("added_tokens", []):
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError(f"{token['content']}: only plain added tokens are supported")
            self.special[token["content"]] = token["id"]
            self.bytes_of[token["id"]] = token["content"].encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self._pre_token = regex.compile(PRE_TOKEN)
        self._pieces = _Pieces(self)

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge the leftmost pair of lowest rank until no pair has a rank."""
        count = len(symbols)
        if count < 2:
            return symbols
        ranks, merged, width = self.ranks, self.merged, 1 << (count - 2).bit_length()
        tree = [NO_RANK] * (2 * width)
        tree[width : width + count - 1] = [
            ranks[a].get(b, NO_RANK) for a, b in zip(symbols, symbols[1:], strict=False)
        ]
        for node in range(width - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a <= b else b
        before, after = list(range(-1, count - 1)), list(range(1, count + 1))
        while (best := tree[1]) < NO_RANK:
            node = 1
            while node < width:
                node += node
                if tree[node] != best:
                    node += 1
            left = node - width
            right = after[left]
            symbols[left] = symbol = merged[best]
            symbols[right] = -1
            beyond = after[left] = after[right]
            low = high = node
            if right < count - 1:
                high = width + right
                tree[high] = NO_RANK
            if beyond < count:
                before[beyond] = left
                tree[node] = ranks[symbol].get(symbols[beyond], NO_RANK)
            else:
                tree[node] = NO_RANK
            if left:
                ahead = before[left]
                low = width + ahead
                tree[low] = ranks[symbols[ahead]].get(symbol, NO_RANK)
            # The changed leaves lie within one token's length of each other.
            while low > 1:
                low >>= 1
                high >>= 1
                for node in range(low, high + 1):
                    a, b = tree[node + node], tree[node + node + 1]
                    tree[node] = a if a <= b else b
        return [s for s in symbols if s >= 0]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one pre-token, without looking at kept ones."""
        raw = piece.encode("utf-8", "replace")
        if self._of_bytes:
            return tuple(self.merge(list(raw.translate(self._of_bytes))))
        return tuple(self.merge([self.byte_ids[b] for b in raw]))

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without added tokens; joined they are the text."""
        return self._pre_token.findall(text)

    def encode(self, text: str) -> list[int]:
        """Ids of a text. Added tokens written out in it become their own ids."""
        kept = self._pieces.__getitem__
        if self._special is None or not self._special.search(text):
            return list(chain.from_iterable(map(kept, self.pieces(text))))
        out: list[int] = []
        for part in self._special.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out.extend(chain.from_iterable(map(kept, self.pieces(part))))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, added tokens included; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class _Pieces(dict):
    """Encodings of pre-tokens, emptied when full. Long ones are not kept."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.vocabulary.encode_piece(piece)
        if len(piece) <= 64:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


@functools.lru_cache(maxsize=2)
def vocabulary(text: str) -> Vocabulary:
    """One vocabulary per worker process."""
    return Vocabulary(text)


def encoded(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (array of int) and ``decoded`` (text of those ids) of every row.

    Whole texts are encoded; a null text counts as empty and has no ids. Null
    and repeated ids are rows like others; other columns are not read. An empty
    table gives an empty result. The vocabulary file is read where the query is
    built and sent to the executors; its size does not depend on the data.
    """
    spec = docs.sparkSession.sparkContext.broadcast(Path(vocabulary_path).read_text(encoding="utf-8"))
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = [vocab.encode(t) for t in part.column(1).to_pylist()]
                ends = np.fromiter(accumulate(map(len, ids), initial=0), np.int32, len(ids) + 1)
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(ends, flat), pa.array(map(vocab.decode, ids), pa.string())],
                    names=[id_col, "ids", "decoded"],
                )

    return rows.mapInArrow(encode, f"`{id_col}` {kind}, ids array<int>, decoded string")


def digests(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token count and SHA-256 of ids and decoded text of ``encoded`` rows."""
    return tokens.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
