"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are assigned values, runs with digits and very long runs. What they
look like, how much of them is dictionary words, where they lie and which words
stand beside them goes into a forest. It learns from labelled findings; without
a table of these, findings whose format or context leaves no doubt are the
labels, and the forest carries them over to the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import random_forest
from millrace.llm.labelled import least_hashes
from millrace.llm.rows import text_or_empty
from millrace.session import written

#: Labelled findings per label that training may see; words of the dictionary.
PER_LABEL, DICTIONARY = 2000, 5000
#: Invented findings of each label beside fewer known secrets.
LEAST = 600
THRESHOLD = 0.5
ROWS = 256

#: Formats that providers document, and words beside secrets and beside harmless runs.
FORMATS = (
    r"AKIA[0-9A-Z]{16}", r"ASIA[0-9A-Z]{16}", r"gh[pousr]_[0-9A-Za-z]{36}", r"xox[abprs]-[0-9A-Za-z-]{10,}",
    r"AIza[0-9A-Za-z_-]{35}", r"sk_live_[0-9A-Za-z]{16,}", r"eyJ[0-9A-Za-z_-]{8,}\.eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}",
)
SECRET_NAMES = (
    "password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "auth", "credential",
    "private_key", "bearer",
)
HARMLESS_NAMES = ("sha", "md5", "commit", "uuid", "guid", "version", "checksum", "digest", "http", "www", "isbn", "phone", "tel")
PLACEHOLDERS = ("example", "changeme", "placeholder", "your", "xxxx", "dummy", "sample", "redacted", "1234567")

_CHAR = "[A-Za-z0-9+/_=.@:-]"
#: A run with a digit or an assignment, a very long one, or one that something assigns.
_CANDIDATE = regex.compile(
    rf"(?<!{_CHAR})(?={_CHAR})(?:(?={_CHAR}*?[0-9=:])|(?={_CHAR}{{24}})|(?<=[\"'=:>]\s*)|(?<=\bis\s+)){_CHAR}{{6,}}+"
)
_FORMAT = regex.compile("|".join(f"(?:{f})" for f in FORMATS))
_ASSIGNED = rf"(?i)(?:{'|'.join(SECRET_NAMES)})[\w-]{{0,60}}\\?[\"'`]?\s*(?::?=+>?|:|\bis\b)\s*"
_NAME = regex.compile(rf"{_ASSIGNED}\\?[\"'`]?$")
_GIVES = regex.compile(_ASSIGNED)
#: What a secret name is given: all between quotes on one line, else all up to the next blank.
_QUOTED = regex.compile(r"(?P<quote>\\?[\"'`])(?P<value>(?:(?!(?P=quote))(?:\\.|[^\n\\]))+)(?P=quote)")
_OPENING = regex.compile(r"\\?[\"'`]?")
_GAP = regex.compile(r"\s|\Z")
#: Characters of invented secrets.
DRAWN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789!#$%&*()~@^?+-_/."
_PAIRS = {")": "(", "]": "[", "}": "{", ">": "<"}
_INNER = regex.compile(r"^(?P<name>[A-Za-z_][\w-]{1,40})[=:](?P<value>.{6,})$")
_HARMLESS = regex.compile(
    r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+\.?|[\d.:+/_-]+|(?i:https?:.*|www\..*)|[A-Za-z_./:=-]+|[\w-]+(?:\.[\w-]+)*\.[a-z]{2,6}(?:/.*)?"
)
_WORD = regex.compile(r"\S+")


@dataclass(frozen=True)
class Lexicon:
    """Frequent words of the corpus and how their letters follow one another."""

    words: frozenset[str]
    steps: np.ndarray

    @classmethod
    def of(cls, counts: dict[str, int]) -> Lexicon:
        steps = np.ones((27, 27))
        for word, count in counts.items():
            codes = [26, *(ord(c) - 97 if "a" <= c <= "z" else 26 for c in word), 26]
            np.add.at(steps, (codes[:-1], codes[1:]), math.log1p(count))
        return cls(frozenset(counts), np.log(steps / steps.sum(axis=1, keepdims=True)))

    def fluency(self, text: str) -> float:
        """Mean log probability of a step from character to character."""
        codes = np.array([ord(c) - 97 if "a" <= c <= "z" else 26 for c in text.lower()])
        return float(self.steps[codes[:-1], codes[1:]].mean()) if len(codes) > 1 else 0.0

    def coverage(self, text: str) -> float:
        """Share of the characters that dictionary words cover, longest first from the left."""
        low, at, covered = text.lower(), 0, 0
        while at < len(low):
            for length in range(min(16, len(low) - at), 2, -1):
                if low[at : at + length] in self.words:
                    covered += length
                    at += length
                    break
            else:
                at += 1
        return covered / max(1, len(low))


def _bare(value: str) -> str:
    """A blank-delimited value without the punctuation of the text around it."""
    spare = {closing: value.count(closing) - value.count(opening) for closing, opening in _PAIRS.items()}
    end = len(value)
    while end and (value[end - 1] in ".,;:\"'`" or spare.get(value[end - 1], 0) > 0):
        end -= 1
        if value[end] in spare:
            spare[value[end]] -= 1
    return value[:end]


def given(text: str) -> list[tuple[int, str]]:
    """Start and value of all that secret names are given, whole and of any length and characters.

    A value may hold a name itself, as in "auth: token=...". Of several names in
    one run without blanks the first and the last count: their values are all of
    it, and what no name follows.
    """
    out, at, end, last = [], 0, -1, None

    def add(start: int, value: str) -> None:
        if value.strip():
            out.append((start, value))

    while match := _GIVES.search(text, at):
        if quoted := _QUOTED.match(text, match.end()):
            at = quoted.start("value")
            add(at, quoted.group("value"))
            continue
        at = _OPENING.match(text, match.end()).end()
        if at < end:
            last = at
            continue
        if last is not None:
            add(last, _bare(text[last:end]))
        end, last = _GAP.search(text, at).start(), None
        add(at, _bare(text[at:end]))
    if last is not None:
        add(last, _bare(text[last:end]))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, str]]:
    """Start and value of what may be a secret."""
    named = given(text)
    #: No run is looked for inside a value; one of several words may hold more.
    taken = [(start, start + len(value)) for start, value in named if not any(c.isspace() for c in value)]
    out, at = dict(named), 0
    for match in _CANDIDATE.finditer(text):
        run, start = match.group().rstrip(".:=-"), match.start()
        inner = _INNER.match(run)
        if inner and not run.startswith(("http:", "https:")):
            start, run = start + inner.start("value"), inner.group("value")
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and taken[at][0] < start + len(run):
            continue
        digit = any("0" <= c <= "9" for c in run)
        if inner or (digit and len(run) >= 10) or len(run) >= 24:
            out.setdefault(start, run)
    return sorted(out.items())


def certain_label(value: str, before: str) -> int | None:
    """1 or 0 where format or context leaves no doubt, else None."""
    low = value.lower()
    if any(p in low for p in PLACEHOLDERS):
        return 0
    if _FORMAT.fullmatch(value):
        return 1
    if _HARMLESS.fullmatch(value):
        return 0
    mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    if _NAME.search(before) and mixed and len(value) >= 12:
        return 1
    if any(n in before.lower()[-24:] for n in HARMLESS_NAMES):
        return 0
    return None


def features(value: str, before: str, after: str, path: str, lexicon: Lexicon) -> list[float]:
    length = len(value)
    kinds = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value]
    count = [kinds.count(k) / length for k in range(4)]
    switches = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, length - 1)
    chars = np.bincount(np.frombuffer(value.encode(), np.uint8))
    share = chars[chars > 0] / chars.sum()
    near, path = before.lower()[-32:], path.lower()
    words = before.split()
    last = xxhash.xxh32_intdigest(words[-1].lower()) % 16 if words else 0
    return [
        math.log(length), *count, switches, float(-(share * np.log2(share)).sum()), len(share) / length,
        float(all(c in "0123456789abcdefABCDEF" for c in value)), float("@" in value), float("." in value),
        lexicon.fluency(value), lexicon.coverage(value), float(any(n in near for n in SECRET_NAMES)),
        float(any(n in near for n in HARMLESS_NAMES)), float(before.rstrip(" \"'")[-1:] in ("=", ":")),
        float(before[-1:] in "\"'" and before != ""), float(after[:1] in "\"'" and after != ""), float(last),
        float(any(n in path for n in ("test", "example", "sample", "doc"))),
        float(any(n in path for n in ("env", "conf", "secret", "deploy"))), xxhash.xxh32_intdigest(path) % 8,
        float(bool(_NAME.search(before))), float(any(c.isdigit() for c in value) and any(c.isalpha() for c in value)),
    ]


def lexicon_of(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> Lexicon:
    """The ``size`` words of 3 to 16 letters that occur in most documents."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty(text_col)), F.lit(r"(?<!\S)\p{L}{3,16}(?!\S)"), 0))
    top = (
        docs.select(F.explode(words).alias("word")).groupBy("word").count().filter("count > 1")
        .orderBy(F.desc("count"), "word").limit(size)
    )
    return Lexicon.of({r["word"]: r["count"] for r in top.collect()})


def findings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source"
) -> DataFrame:
    """Every candidate of every whole text: ``id_col, path, start, value, before, after, label``.

    ``start`` counts code points. ``label`` is set where format or context
    leaves no doubt.
    """
    path = F.coalesce(F.col(path_col), F.lit("")).alias("path") if path_col in docs.columns else F.lit("").alias("path")
    rows = docs.select(id_col, path, text_or_empty(text_col).alias("_text"))
    names = [id_col, "path", "start", "value", "before", "after", "label"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                owner, out = [], []
                for n, text in enumerate(part.column(2).to_pylist()):
                    for start, value in candidates(text):
                        before, end = text[max(0, start - 60) : start], start + len(value)
                        out.append((start, value, before, text[end : end + 20], certain_label(value, before)))
                        owner.append(n)
                take = pa.array(owner, pa.int64())
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take),
                     *[pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)]],
                    names=names,
                )

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(
        find, f"`{id_col}` {kind}, path string, start long, value string, before string, after string, label int"
    )


def invented(rows: list[tuple], lexicon: Lexicon, seed: int = 3) -> list[tuple]:
    """For each secret among ``rows`` drawn values and plain words, assigned in drawn forms at its place.

    A corpus shows few forms of secrets and of assignments; how one is written
    must not tell the forest that it is none.
    """
    rng, plain, out = np.random.default_rng(seed), sorted(lexicon.words) or ["none"], []
    secret = [r for r in rows if r[4] == 1]
    for _, before, after, path, _ in secret * max(1, LEAST // len(secret)):
        word, other = (plain[int(n)] for n in rng.integers(0, len(plain), 2))
        mixed = other + str(rng.integers(0, 1000))
        if rng.random() < 0.6:
            kinds = DRAWN if rng.random() < 0.6 else DRAWN[26:62]
            mixed = "".join(rng.choice(list(kinds), int(rng.integers(4, 31)))) + str(rng.choice(list("abcdefghkm"))) + str(rng.integers(0, 10))
        for value, sign in ((mixed, 1), (word, 0)):
            quote = str(rng.choice(["", "", '"', "'"]))
            assigned = str(rng.choice(SECRET_NAMES)) + str(rng.choice(["=", ": ", " = ", ":", '": ', "': ", " is "])) + quote
            out.append((value, (before[:30] + " " + assigned)[-60:], (quote + after)[:20], path, sign))
    return out


def train(
    labelled: DataFrame, lexicon: Lexicon, per_label: int = PER_LABEL, more: bool = False
) -> random_forest.RandomForest | None:
    """A forest from at most ``per_label`` findings of each label, chosen by a
    hash of value and context, and with ``more`` from ``invented`` ones beside
    them; None unless both labels occur."""
    key = F.concat_ws("|", "value", "before", F.col("start").cast("string"))
    rows = []
    for label in (0, 1):
        chosen = least_hashes(labelled.filter(F.col("label") == label), key, per_label)
        rows += chosen.select("value", "before", "after", "path", "label").collect()
    y = np.array([r["label"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    if more:
        rows += invented(rows, lexicon)
    x = np.array([features(*r[:4], lexicon) for r in rows])
    return random_forest.grow(x, np.array([r[4] for r in rows], float))


def scanned(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
    path_col: str = "source", threshold: float = THRESHOLD,
) -> DataFrame:
    """All candidates with the forest's score.

    Columns: ``id_col, path, start, length, value, score, is_secret``.
    ``labelled`` has the columns of ``findings``; by default the findings with
    a certain label are used. Without both labels the score is the certain
    label, or 0. A null text has no candidates; null and repeated ids are rows
    like others; other columns are not read; an empty table gives an empty
    result.
    """
    found = written(findings(docs, id_col, text_col, path_col), "findings")
    lexicon = lexicon_of(docs, text_col)
    forest = train(found if labelled is None else labelled, lexicon, more=labelled is None)
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, forest))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, forest = shared.value
        for batch in batches:
            columns = batch.to_pydict()
            given = zip(*(columns[c] for c in ("value", "before", "after", "path")), strict=True)
            if forest is None:
                scores = np.array([float(v or 0) for v in columns["label"]])
            elif batch.num_rows:
                scores = forest.scores(np.array([features(*g, lexicon) for g in given]))
            else:
                scores = np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(map(len, columns["value"]), pa.int64()),
                 batch.column(3), pa.array(scores, pa.float64()), pa.array(scores >= threshold)],
                names=[id_col, "path", "start", "length", "value", "score", "is_secret"],
            )

    kind = found.schema[id_col].dataType.simpleString()
    return found.mapInArrow(
        score, f"`{id_col}` {kind}, path string, start long, length long, value string, score double, is_secret boolean"
    )
