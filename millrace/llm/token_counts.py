"""Token counts that follow edits.

A document's pre-tokens lie in short leaves under a segment tree whose nodes
hold the characters and tokens below them. An edit finds its leaf by descending
on character sums, cuts pre-tokens again only from shortly before the edit to
the first old boundary that fits after it, encodes just those, and updates the
sums on the way up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import CACHED_PIECES, Vocabulary, vocabulary

LEAF = 32
ROWS = 256


class Edit(NamedTuple):
    """Replace the characters from ``start`` to ``end`` of the current text."""

    start: int
    end: int
    text: str


def whole_pattern(special: Sequence[str]) -> regex.Pattern:
    """Pre-tokens and added tokens in one pattern, so that a text can be cut from any boundary on."""
    added = "|".join(map(regex.escape, sorted(special, key=len, reverse=True)))
    hold = f"(?!{added})" if added else ""
    first = f"{added}|" if added else ""
    return regex.compile(
        rf"{first}'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?(?:{hold}[^\s\p{{L}}\p{{N}}])+|\s+(?!{hold}\S)|\s+"
    )


class Counter:
    """Counts tokens of pre-tokens and remembers the last ones."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.pattern = whole_pattern(list(vocab.special))
        #: A boundary is safe when no edit comes within this many characters of it.
        self.reach = max(map(len, vocab.special), default=0) + 3
        self.tokens: Callable[[str], int] = _Known(vocab).__getitem__

    def cut(self, text: str) -> list[str]:
        """Pre-tokens and added tokens of a whole text; without added tokens a pattern that need not look ahead."""
        if any(s in text for s in self.vocab.special):
            return self.pattern.findall(text)
        return self.vocab.pieces(text)

    def total(self, text: str) -> int:
        return sum(map(self.tokens, self.cut(text)))


class _Known(dict):
    """Tokens of each pre-token, emptied when full. Long ones are not kept."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab

    def __missing__(self, piece: str) -> int:
        count = 1 if piece in self.vocab.special else len(self.vocab.encode_piece(piece))
        if len(piece) <= 64:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = count
        return count


class TokenTree:
    """Token count of one document under edits.

    ``encoded`` tells how many pre-tokens were cut and encoded so far.
    """

    def __init__(self, text: str, counter: Counter) -> None:
        self.text, self.counter, self.encoded = text, counter, 0
        pieces = counter.cut(text)
        self._build(list(zip(map(len, pieces), map(counter.tokens, pieces))))
        self.encoded = sum(map(len, self.leaves))

    def _build(self, pieces: list[tuple[int, int]]) -> None:
        self.leaves = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.counts = [0] * (2 * self.width), [0] * (2 * self.width)
        for n, leaf in enumerate(self.leaves):
            self.chars[self.width + n] = sum(p[0] for p in leaf)
            self.counts[self.width + n] = sum(p[1] for p in leaf)
        for node in range(self.width - 1, 0, -1):
            self._add_up(node)

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.counts[node] = self.counts[2 * node] + self.counts[2 * node + 1]

    @property
    def total(self) -> int:
        return self.counts[1]

    def _find(self, place: int) -> tuple[int, int, int]:
        """Leaf, index in it and start of the pre-token that holds character ``place``."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        leaf = node - self.width
        for index, (length, _) in enumerate(self.leaves[leaf]):
            if place < start + length:
                return leaf, index, start
            start += length
        return leaf, len(self.leaves[leaf]), start

    def apply(self, edit: Edit) -> None:
        """Edit the text and bring the count up to date."""
        old = self.text
        self.text = old[: edit.start] + edit.text + old[edit.end :]
        first, index, start = self._find(max(0, edit.start - self.counter.reach))
        last, after, end = self._find(edit.end)
        moved, new_end, fresh = len(self.text) - len(old), edit.start + len(edit.text), []
        at = start
        for match in self.counter.pattern.finditer(self.text, start):
            while end + moved < match.start() and (step := self._piece(last, after)):
                last, after, end = step[0], step[1], end + step[2]
            if match.start() >= new_end and match.start() == end + moved:
                break
            fresh.append((match.end() - match.start(), self.counter.tokens(match.group())))
            at = match.end()
        if at == len(self.text):
            last, after = len(self.leaves) - 1, len(self.leaves[-1])
        self.encoded += len(fresh)
        kept = self.leaves[first][:index] + fresh
        rest = self.leaves[last][after:]
        if first == last:
            changed = {first: kept + rest}
        else:
            changed = {first: kept, last: rest} | {n: [] for n in range(first + 1, last)}
        for n, leaf in changed.items():
            self.leaves[n] = leaf
        if len(self.leaves[first]) > 8 * LEAF:
            self._build([p for leaf in self.leaves for p in leaf])
            return
        for n in changed:
            node = self.width + n
            self.chars[node] = sum(p[0] for p in self.leaves[n])
            self.counts[node] = sum(p[1] for p in self.leaves[n])
            while node > 1:
                node //= 2
                self._add_up(node)

    def _piece(self, leaf: int, index: int) -> tuple[int, int, int] | None:
        """Place after the pre-token there, and its length; None at the end."""
        while leaf < len(self.leaves):
            if index < len(self.leaves[leaf]):
                return leaf, index + 1, self.leaves[leaf][index][0]
            leaf, index = leaf + 1, 0
        return None


#: What the masking edits look for, and what they write instead.
MASKS = (
    (r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", "<EMAIL>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<IP>"),
    (r"\bAKIA[0-9A-Z]{16}\b", "<KEY>"),
    (r"\b[0-9a-f]{16,}\b", "<HEX>"),
    (r"\+?\d[\d ()-]{7,}\d", "<NUMBER>"),
)
_MASK = regex.compile("|".join(f"(?P<m{n}>{p})" for n, (p, _) in enumerate(MASKS)))
_SEEN = regex.compile(r"\d")


def masking_edits(text: str) -> list[Edit]:
    """Edits that hide addresses, keys and long numbers, as offsets into the text as it changes."""
    if not _SEEN.search(text) and "@" not in text:
        return []
    out, moved = [], 0
    for match in _MASK.finditer(text):
        new = MASKS[int(match.lastgroup[1:])][1]
        out.append(Edit(match.start() + moved, match.end() + moved, new))
        moved += len(new) - (match.end() - match.start())
    return out


def edited_counts(
    docs: DataFrame, vocabulary_path: str, edits: Callable[[str], list[Edit]] = masking_edits, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token counts of whole texts before and after their edits.

    Columns: ``id_col, n_pieces`` (pre-tokens before), ``n_tokens`` (before),
    ``n_edits, n_encoded`` (pre-tokens encoded for the edits), ``n_tokens_after``.
    A null text counts as empty: all 0. Null and repeated ids are rows like
    others; other columns are not read; an empty table gives an empty result.
    """
    spec = docs.sparkSession.sparkContext.broadcast(Path(vocabulary_path).read_text(encoding="utf-8"))
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    names = ["n_pieces", "n_tokens", "n_edits", "n_encoded", "n_tokens_after"]

    def measure(text: str, counter: Counter) -> tuple[int, ...]:
        changes = edits(text)
        if not changes:
            pieces = counter.cut(text)
            total = sum(map(counter.tokens, pieces))
            return len(pieces), total, 0, 0, total
        tree = TokenTree(text, counter)
        pieces, total = tree.encoded, tree.total
        for change in changes:
            tree.apply(change)
        return pieces, total, len(changes), tree.encoded - pieces, tree.total

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary(spec.value))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out = np.array([measure(t, counter) for t in part.column(1).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, out.T)], names=[id_col, *names])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(count, f"`{id_col}` {kind}, " + ", ".join(f"{n} long" for n in names))
