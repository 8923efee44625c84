"""Quality rules: fixed base rules, then boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.labelled import labelled_texts
from millrace.llm.trees import Forest, grow

SYMBOLS = b"#*$%&|<>"
PER_LABEL = 2000
#: A document is kept from this probability of good quality on.
THRESHOLD = 0.5
LEAST_WORDS, MOST_REPEATED = 50, 50
ROWS = 512

#: What the trees see, and whether more of it may raise (1) or lower (-1) the score.
FEATURES: dict[str, int] = {
    "word_length": 0, "symbols": -1, "duplicate_lines": -1, "repeated_words": -1, "distinct_words": 0,
    "capitals": 0, "digits": 0, "ascii_marks": 0, "commonest_word": -1, "commonest_byte": 0, "line_words": 0,
    "closed_lines": 0, "short_words": 0, "long_words": 0, "byte_entropy": 0,
}

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_CAPITAL = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_LETTER = _CAPITAL | ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | (np.arange(256) >= 128)
_MARK = ~(_LETTER | _DIGIT | _SPACE)
_INNER = (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0)


def repeated_windows(ids: np.ndarray, width: int = 3) -> np.ndarray:
    """Which positions lie in a window of ``width`` ids that occurs twice or more."""
    marked = np.zeros(len(ids), bool)
    if len(ids) < width:
        return marked
    code = ids[: len(ids) - width + 1].astype(np.int64)
    for i in range(1, width):
        code = code * (int(ids.max()) + 1) + ids[i : len(ids) - width + 1 + i]
        if i < width - 1 or len(ids) > 1 << 20:
            code = np.unique(code, return_inverse=True)[1]
    _, which, count = np.unique(code, return_inverse=True, return_counts=True)
    again = count[which] > 1
    for i in range(width):
        marked[i : len(marked) - width + 1 + i] |= again
    return marked


def measure(text: bytes) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """Counts of the contract (words, word characters, symbols, duplicate lines,
    repeated words) and the trees' features of one text in UTF-8."""
    words = text.split()
    total = len(words)
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    length = int(histogram.sum())
    word_bytes = length - int(histogram[_SPACE].sum())
    word_chars = word_bytes - int(histogram[_INNER].sum())
    symbols = int(histogram[_SYMBOL].sum())
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, total)
    repeated = int(repeated_windows(ids).sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    duplicates = len(lines) - len(set(lines))
    counts = (total, word_chars, symbols, duplicates, repeated)
    if not total:
        return counts, [0.0] * len(FEATURES)
    lengths = np.fromiter(map(len, words), np.int64, total)
    share = histogram[histogram > 0] / length
    closed = sum(line.rstrip()[-1:] in b".!?:;" for line in lines)
    return counts, [
        word_chars / total, symbols / word_bytes, duplicates / len(lines), repeated / total,
        np.log1p(len(seen)) / np.log1p(total), histogram[_CAPITAL].sum() / word_bytes, histogram[_DIGIT].sum() / word_bytes,
        histogram[_MARK].sum() / word_bytes, np.bincount(ids).max() / total, share.max(), np.log1p(total / len(lines)),
        closed / len(lines), (lengths <= 3).mean(), (lengths >= 12).mean(), float(-(share * np.log(share)).sum()),
    ]


def train(texts: list[bytes], labels: list[int]) -> Forest | None:
    """Trees fitted to labelled texts, both labels weighing alike; None without both."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.array([measure(t)[1] for t in texts])
    weight = np.where(y == 1, 1.0, (y == 1).sum() / (y == 0).sum())
    return grow(x, y, weight, list(FEATURES.values()))


def fitted(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Forest | None:
    return train(*labelled_texts(docs, labels, "quality", per_label))


def judged(
    docs: DataFrame, forest: Forest | None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts, base rules and verdict of every whole text.

    Columns: ``id_col, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, quality``. A null text counts as empty:
    all counts 0, failed. Without a forest (labels of one kind or none) only
    the base rules decide. Null and repeated ids are rows like others; other
    columns are not read.
    """
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                counts, features = zip(*map(measure, part.column(1).to_pylist()), strict=True)
                counts = np.array(counts, np.int64)
                failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
                quality = np.ones(len(counts)) if shared.value is None else shared.value.scores(np.array(features))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, counts.T), pa.array(failed),
                     pa.array(~failed & (quality >= threshold)), pa.array(quality)],
                    names=[id_col, *counted, "base_failed", "kept", "quality"],
                )

    kind = rows.schema[id_col].dataType.simpleString()
    columns = ", ".join(f"{c} long" for c in counted)
    return rows.mapInArrow(judge, f"`{id_col}` {kind}, {columns}, base_failed boolean, kept boolean, quality double")
