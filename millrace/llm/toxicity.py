"""Toxicity of whole texts: the most toxic of their overlapping windows.

A label says that a text is toxic, not where. Training therefore alternates:
the current network scores all windows of each text and picks a suspicious one,
and these windows are learnt with the text's label, together with random windows
of clean texts, until the loss of whole texts set apart no longer falls. A logistic
curve over the greatest window logit of these gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.llm import gru
from millrace.llm.labelled import held_out, labelled_texts

#: Texts per update, updates between two searches of all windows, rounds without gain that end
#: training, the loss of whole texts that is low enough, and the share of it that counts as a gain.
STEP, UPDATES, PATIENCE, ENOUGH, GAIN = 96, 32, 4, 0.02, 0.02
RATE = 0.006
#: Texts of a label from which a third of them is set apart.
APART = 60
#: Labelled documents per label value that training may see.
PER_LABEL = 1200
#: What the score needs to be reported as toxic.
THRESHOLD = 0.7
ROWS = 256

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


@dataclass(frozen=True)
class ToxicityModel:
    """Network, and the curve from greatest window logit to score. Without a
    network (no toxic or no clean example with words was given) every score is 0."""

    params: gru.Params | None
    slope: float = 1.0
    shift: float = 0.0

    def scores(self, scorer: gru.Scorer | None, texts: list[bytes]) -> np.ndarray:
        if self.params is None or scorer is None:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * greatest(scorer, texts) + self.shift, -40, 40)))


def greatest(scorer: gru.Scorer, texts: list[bytes]) -> np.ndarray:
    """Greatest window logit of each text; a text without words gets the least value, -20."""
    logits, owner = scorer.window_logits([words_of(t) for t in texts])
    out = np.full(len(texts), -20.0)
    np.maximum.at(out, owner, logits.astype(float))
    return out


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> ToxicityModel:
    """Fit network and curve; the same input gives the same model.

    A third of each label's texts first tells how many rounds to train and how
    far to trust a logit; then the network learns from all texts for as long.
    Of fewer than ``APART`` texts of a label none can be spared: all tell both.
    """
    known = [(d, t) for d, t in zip(map(words_of, texts), labels, strict=True) if d]
    docs, target = tuple(d for d, _ in known), np.array([t for _, t in known], float)
    if not len(target) or target.min() == target.max():
        return ToxicityModel(None)
    own = [np.flatnonzero(target == label) for label in (0, 1)]
    if min(map(len, own)) < APART:
        params, _, top = _network(docs, target, seed, docs, target)
        return ToxicityModel(params, *_curve(top, target))
    apart = np.zeros(len(docs), bool)
    for part in own:
        apart[np.random.default_rng(seed).permutation(part)[: len(part) // 3]] = True
    learnt = tuple(d for d, a in zip(docs, apart, strict=True) if not a)
    spared = tuple(d for d, a in zip(docs, apart, strict=True) if a)
    _, rounds, top = _network(learnt, target[~apart], seed, spared, target[apart])
    params, _, _ = _network(docs, target, seed, rounds=rounds)
    return ToxicityModel(params, *_curve(top, target[apart]))


def _balance(target: np.ndarray) -> np.ndarray:
    return np.where(target == 1, (target == 0).sum() / max(1, (target == 1).sum()), 1.0)


def associations(docs: tuple[list[bytes], ...], target: np.ndarray) -> np.ndarray:
    """Log odds that a text which holds a word of the bucket is toxic, less twice their standard error."""
    counts = np.zeros((2, gru.WORDS))
    for words, label in zip(docs, target, strict=True):
        counts[int(label), np.unique(gru.features(sorted(set(words)))[0])] += 1
    totals = np.array([[(target == 0).sum()], [(target == 1).sum()]])
    held, free = counts + 0.5, totals - counts + 0.5
    odds = np.log(held[1] * free[0] / (held[0] * free[1]))
    return np.sign(odds) * np.maximum(0, np.abs(odds) - 2 * np.sqrt((1 / held + 1 / free).sum(axis=0)))


def _network(
    docs: tuple[list[bytes], ...], target: np.ndarray, seed: int, judges: tuple[list[bytes], ...] = (),
    verdict: np.ndarray | None = None, rounds: int = 0,
) -> tuple[gru.Params, int, np.ndarray]:
    """Parameters, rounds and greatest logits of ``judges``: after ``rounds``, or when the loss of ``judges`` is least."""
    trainer = gru.Trainer(seed, told=associations(docs, target))
    rng = trainer.rng
    balance, clean_docs = _balance(target), np.flatnonzero(target == 0)
    picked = np.array([int(rng.choice(gru.windows(len(d)))) for d in docs])
    best, kept, idle, number = np.inf, None, 0, 0
    while number < rounds or (not rounds and (kept is None or (idle < PATIENCE and best > ENOUGH))):
        trainer.rate = RATE / (1 + number / 4) + RATE / 10
        for _ in range(UPDATES):
            some = rng.integers(0, len(docs), STEP)
            more = [docs[n] for n in rng.choice(clean_docs, STEP // 4)]
            odd = [_repeating(docs[n], rng) for n in rng.choice(clean_docs, STEP // 5)]
            free = [d[s : s + gru.WIDTH] for d in more for s in [int(rng.integers(0, len(d)))]]
            trainer.update(
                [docs[n][picked[n] : picked[n] + gru.WIDTH] for n in some] + free + odd,
                np.concatenate([target[some], np.zeros(len(free) + len(odd))]),
                np.concatenate([balance[some], np.full(len(free) + len(odd), 1.0)]),
            )
        number += 1
        picked = _picked(trainer.p, docs, target, rng)[0]
        if rounds:
            continue
        top = _greatest(trainer.p, judges)
        slope, shift = _curve(top, verdict)
        loss = float(np.logaddexp(0, np.where(verdict == 1, -1, 1) * (slope * top + shift)).mean())
        idle = 0 if loss < best * (1 - GAIN) else idle + 1
        if loss < best:
            best, kept = loss, ({k: v.copy() for k, v in trainer.p.items()}, number, top)
    return kept or (trainer.p, number, np.empty(0))


def _greatest(p: gru.Params, docs: tuple[list[bytes], ...]) -> np.ndarray:
    """Greatest window logit of each text that has words."""
    scorer, out = gru.Scorer(p), np.full(len(docs), -np.inf)
    for at in range(0, len(docs), ROWS):
        logits, owner = scorer.window_logits(list(docs[at : at + ROWS]))
        np.maximum.at(out, owner + at, logits.astype(float))
    return out


def _repeating(words: list[bytes], rng: np.random.Generator) -> list[bytes]:
    """Clean words, each several times in a row: repetition alone is not toxic."""
    times = int(rng.integers(3, gru.WIDTH))
    some = [words[int(i)] for i in rng.integers(0, len(words), gru.WIDTH // times + 1)]
    return [w for w in some for _ in range(times)][: gru.WIDTH]


def _picked(
    p: gru.Params, docs: tuple[list[bytes], ...], target: np.ndarray, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """Start of the window to learn of each text, and the greatest logit of all its windows.

    Of a clean text it is the most suspicious window. Of a toxic one each window
    is drawn with the odds its logit gives it, for the greatest alone would fix
    an early mistake.
    """
    scorer, starts, top = gru.Scorer(p), [], []
    for at in range(0, len(docs), ROWS):
        part = docs[at : at + ROWS]
        logits, owner = scorer.window_logits(list(part))
        ends = np.searchsorted(owner, np.arange(len(part) + 1))
        for n, words in enumerate(part):
            own = logits[ends[n] : ends[n + 1]]
            drawn = own + rng.gumbel(size=len(own)) if target[at + n] == 1 else own
            starts.append(int(gru.windows(len(words))[np.argmax(drawn)]))
            top.append(float(own.max()))
    return np.array(starts), np.array(top)


def _curve(top: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the greatest logit, lightly held back."""
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * top + shift, -40, 40)))
        w, miss = p * (1 - p) + 1e-6, p - target
        hess = np.array([[(w * top * top).sum() + 1.0, (w * top).sum()], [(w * top).sum(), w.sum() + 1e-3]])
        move = np.linalg.solve(hess, [(miss * top).sum() + (slope - 1.0), miss.sum()])
        slope, shift = float(slope - np.clip(move[0], -1, 1)), float(shift - np.clip(move[1], -5, 5))
    return max(slope, 0.05), shift


def fitted(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> ToxicityModel:
    """A model from labelled rows outside the held-out fold."""
    return train(*labelled_texts(docs, labels, "toxic", per_label))


def scored(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score in [0, 1] for every whole text, over all its windows.

    A null text counts as empty and scores as a text without words does. All
    other columns pass through unread; a column already called ``score_col`` is
    replaced. An empty table gives an empty result.
    """
    if score_col in docs.columns:
        docs = docs.drop(score_col)
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = gru.Scorer(model.params) if model.params is not None else None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = [t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()]
                out = pa.array(model.scores(scorer, texts), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*part.schema.names, score_col])

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))


def judged(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row. Labels, language,
    source and id never enter a score; null and repeated ids are rows like others."""
    rows = scored(docs.select("doc_id", "text"), fitted(docs, labels, per_label))
    return rows.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def clean(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text is not found toxic, with their own columns."""
    return scored(docs, model, score_col="__toxicity").filter(F.col("__toxicity") < threshold).select(docs.columns)
