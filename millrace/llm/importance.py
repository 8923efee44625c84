"""Importance resampling of documents towards a target distribution.

Words come from an Aho-Corasick automaton: the different words of the texts at
hand, each between two blanks, carry their CRC-32 and length, and a scan emits
these payloads in order. CRCs of runs of words follow from the payloads of
neighbours without touching the text again, so a run's bucket costs a few table
lookups. The dictionary is bounded: it holds words of recent texts and starts
anew when full, and words too long for it have their payload computed.

One pass counts buckets of all documents and of the target, another one adds up
the gains of each document's buckets. Only the counts, 10,000 numbers, pass
through the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.crc import joined
from millrace.llm.rows import ranked
from millrace.session import written

BUCKETS = 10_000
RUN = 3
#: Bytes of words in a dictionary, of a word in it, and of text scanned at once.
DICTIONARY, LONGEST, PIECE, LOT = 1 << 21, 256, 1 << 20, 1 << 22
_SPACE = zlib.crc32(b" ")

#: Letters A-Z in lower case; every ASCII character but digits and letters becomes a blank.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


class Dictionary:
    """Payloads of words, ``CRC | length << 32``, through an automaton."""

    def __init__(self, limit: int = DICTIONARY) -> None:
        self.limit = limit
        self._start()

    def _start(self) -> None:
        self.automaton, self.known, self.size = ahocorasick.Automaton(), set(), 0

    def learn(self, words: set[bytes]) -> None:
        """Make room for the words and add those that are new."""
        new = words - self.known
        if self.size and self.size + sum(map(len, new)) > self.limit:
            self._start()
            new = words
        for word in new:
            self.automaton.add_word(f" {word.decode('latin-1')} ", zlib.crc32(word) | len(word) << 32)
            self.size += len(word)
        self.known |= new
        if new:
            self.automaton.make_automaton()

    def scan(self, piece: bytes) -> np.ndarray:
        """Payloads of the words of a piece that were all learnt; each ends at its own blank."""
        if not self.known:
            return np.zeros(0, np.int64)
        return np.fromiter(map(itemgetter(1), self.automaton.iter(f" {piece.decode('latin-1')} ")), np.int64)


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Cuts of a text at blanks, a piece long unless a word is longer."""
    at = 0
    while len(raw) - at > PIECE:
        cut = raw.rfind(b" ", at, at + PIECE)
        if cut <= at and (cut := raw.find(b" ", at + PIECE)) < 0:
            break
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def payloads(texts: Iterator[bytes], dictionary: Dictionary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text, payload)`` of all words in order, a lot of words at a time."""
    lot: list[tuple[int, bytes, bool]] = []
    words: set[bytes] = set()
    size = fresh = 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        dictionary.learn(words)
        found = [
            dictionary.scan(piece) if short
            else np.array([zlib.crc32(w) | len(w) << 32 for w in piece.split()], np.int64)
            for _, piece, short in lot
        ]
        return np.repeat([place for place, _, _ in lot], list(map(len, found))), np.concatenate(found)

    for place, text in enumerate(texts):
        for piece in _pieces(text.translate(_PLAIN)):
            held = set(piece.split())
            short = max(map(len, held), default=0) <= LONGEST
            new = held - words if short else set()
            fresh_here = sum(map(len, new))
            if lot and (size + len(piece) > LOT or fresh + fresh_here > dictionary.limit):
                yield flush()
                lot, words, size, fresh = [], set(), 0, 0
                new = held if short else set()
                fresh_here = sum(map(len, new))
            lot.append((place, piece, short))
            words |= new
            size, fresh = size + len(piece), fresh + fresh_here
    if lot:
        yield flush()


def runs(texts: Iterator[bytes], dictionary: Dictionary) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(text of each word, text of each run, bucket of each run)``, a lot at a time.

    A run of two or three words may begin in the lot before.
    """
    of, payload = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for more_of, more in payloads(texts, dictionary):
        old = min(len(of), RUN - 1)
        of, payload = np.concatenate((of[len(of) - old :], more_of)), np.concatenate((payload[len(payload) - old :], more))
        word, length = (payload & 0xFFFFFFFF).astype(np.uint32), payload >> 32
        spaced = joined(np.full(len(word), _SPACE, np.uint32), word, length)
        texts_, crcs, crc = [of[old:]], [word[old:]], word
        for n in range(1, RUN):
            crc = joined(crc[:-1], spaced[n:], length[n:] + 1)
            inside = of[n:] == of[:-n] if len(of) > n else np.zeros(0, bool)
            inside[: max(0, old - n)] = False
            texts_.append(of[n:][inside])
            crcs.append(crc[inside])
        yield of[old:], np.concatenate(texts_), (np.concatenate(crcs) % BUCKETS).astype(np.int64)


def _texts(batch: pa.RecordBatch, place: int) -> Iterator[bytes]:
    return (t.as_py() or b"" for t in batch.column(place).cast(pa.binary()))


def bucket_counts(docs: DataFrame, text_col: str = "text", least_words: int = 20) -> tuple[np.ndarray, int]:
    """How often each bucket occurs in all texts, and the texts of ``least_words`` words or more."""
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, total = Dictionary(), np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            words = np.zeros(batch.num_rows, np.int64)
            for of, _, bucket in runs(_texts(batch, 0), dictionary):
                words += np.bincount(of, minlength=len(words))
                total[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
            total[BUCKETS] += (words >= least_words).sum()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    counts = np.zeros(BUCKETS + 1, np.int64)
    for row in rows.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts[:BUCKETS], int(counts[BUCKETS])


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a bucket adds to a document's weight, in thousandths, rounded down."""
    raw_all, target_all = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * raw_all / ((s + 1.0) * target_all)))
        for s, t in zip(raw.tolist(), target.tolist())
    ], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_features, weight`` of every row."""
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, gain = Dictionary(), sent.value
        for batch in batches:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for of, run_of, bucket in runs(_texts(batch, 1), dictionary):
                words += np.bincount(of, minlength=n)
                features += np.bincount(run_of, minlength=n)
                weight += np.rint(np.bincount(run_of, gain[bucket], n)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words, features, weight))], names=[id_col, "n_words", "n_features", "weight"]
            )

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(score, f"`{id_col}` {kind}, n_words long, n_features long, weight long")


def luck(id_col: str, seed: int) -> Column:
    """A Gumbel draw in thousandths, rounded down, from the SHA-256 of seed and id; a null id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """Every row's ``id_col, n_words, n_features, weight, score`` and ``rank`` in the draw.

    ``weight`` adds the gain of each run of one to three words; ``score`` adds
    luck. Of the rows with ``least_words`` words the ``percent`` with the
    highest scores are drawn, ties to the smaller id; ``rank`` is null for the
    others. Null and empty texts have no runs and weight 0. Null and repeated
    ids are rows of their own (a null id comes last in ties); other columns are
    not read; an empty table gives an empty result, an empty target equal odds
    for all its buckets.
    """
    raw, enough = bucket_counts(docs, text_col, least_words)
    wanted, _ = bucket_counts(target, target_text, least_words)
    weighed = written(scored(docs, gains(raw, wanted), id_col, text_col), "weights")  # to rank is to read twice
    rows = weighed.withColumn("score", F.col("weight") + luck(id_col, seed))
    order = [(F.col("n_words") < least_words).asc(), F.col("score").desc(), F.col(id_col).asc_nulls_last()]
    drawn = F.col("_rank") < percent * enough // 100
    return ranked(rows, [], order, "_rank").select(
        id_col, "n_words", "n_features", "weight", "score", F.when(drawn, F.col("_rank") + 1).alias("rank")
    )


