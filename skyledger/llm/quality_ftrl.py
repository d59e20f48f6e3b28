"""Quality scores by logistic regression on hashed word n-grams, learned with follow-the-regularised-leader updates.

A text is cut into stretches of letters and of punctuation. Single stretches and neighbouring pairs are hashed into a
table of weights; a stretch that repeats the one before it makes a pair of its own kind, so repetition is seen whatever
is repeated. A score is the sparse dot product of the text's n-gram frequencies with the weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import labelled
from skyledger.llm import text_arrays as ta

BITS = 18
PASSES = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
#: n-gram frequencies are scaled by this, so that a text of one n-gram can outweigh the constant.
SCALE = 30.0

_KIND = np.where(ta.LETTERS, 1, np.where(ta.WHITE, 0, 2)).astype(np.int8)
_SAME = np.uint64(0x1F83D9ABFB41BD6B)


def features(run: ta.Run) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the n-grams of all texts of a run, text by text, and where each text's begin."""
    kind = _KIND[run.data]
    letters, marks = kind == 1, kind == 2
    spans = [ta.word_spans(run, letters), ta.word_spans(run, marks)]
    starts, ends = (np.concatenate([s[i] for s in spans]) for i in (0, 1))
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    hashes = ta.Prefix(run.data, ta.FOLD).hashes(starts, ends)
    at = np.searchsorted(starts, run.offsets)
    pairs, pair_at = ta.shingles(hashes, at, 2)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    lone = np.diff(at) == 1
    # pair i of a text stands for its stretches i and i + 1; a text of one stretch has that one as its pair
    second = np.arange(len(pairs)) + np.repeat(np.where(lone, 0, 1), np.diff(pair_at))
    second += np.repeat(at[:-1] - pair_at[:-1], np.diff(pair_at))
    pairs[same[second] & ~np.repeat(lone, np.diff(pair_at))] = _SAME
    shift = np.uint64(64 - BITS)
    singles = (hashes >> shift).astype(np.int64)
    pairs = (ta.mix(pairs) >> shift).astype(np.int64)
    sizes = np.diff(at) + np.diff(pair_at)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(begins[-1], np.int64)
    out[np.arange(len(singles)) + np.repeat(pair_at[:-1], np.diff(at))] = singles
    out[np.arange(len(pairs)) + np.repeat(at[1:], np.diff(pair_at))] = pairs
    return out, begins


@dataclass
class Model:
    """Weights of the n-grams and the constant."""

    weights: np.ndarray
    constant: float

    def scores(self, run: ta.Run) -> np.ndarray:
        index, begins = features(run)
        total = np.concatenate([[0.0], np.cumsum(self.weights[index], dtype=np.float64)])
        n = np.diff(begins)
        linear = SCALE * (total[begins[1:]] - total[begins[:-1]]) / np.maximum(n, 1) + self.constant
        return 1 / (1 + np.exp(-np.clip(linear, -60, 60)))


def _rows(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The n-grams of each text and their values, and the constant."""
    rows = []
    for run in ta.runs(labelled.as_column(texts)):
        index, begins = features(run)
        for i in range(run.count):
            own, counts = np.unique(index[begins[i] : begins[i + 1]], return_counts=True)
            rows.append((np.append(own, 1 << BITS), np.append(SCALE * counts / max(counts.sum(), 1), 1.0)))
    return rows


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def _train(sums: np.ndarray, texts: list[str], y: np.ndarray, passes: int = 1) -> np.ndarray:
    """The sums z and n of each n-gram, the constant last, after some passes over texts."""
    z, n = sums[:, 0].copy(), sums[:, 1].copy()
    rows = _rows(texts)
    for _ in range(passes):
        for (i, x), label in zip(rows, y):
            w = _weights(z[i], n[i])
            p = 1 / (1 + np.exp(-np.clip(w @ x, -60, 60)))
            g = (p - label) * x
            more = n[i] + g * g
            z[i] += g - (np.sqrt(more) - np.sqrt(n[i])) / ALPHA * w
            n[i] = more
    return np.stack([z, n], axis=1)


def _model(sums: np.ndarray) -> Model:
    w = _weights(sums[:, 0], sums[:, 1])
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def _start() -> np.ndarray:
    return np.zeros(((1 << BITS) + 1, 2))


def learn(texts: list[str], y: np.ndarray, passes: int = PASSES) -> Model:
    """A model from texts and labels in one place; without both classes, one that gives every text the share of the class there is."""
    return _model(_train(_start(), texts, y, passes))


def learn_all(rows: DataFrame, passes: int = PASSES) -> Model:
    """A model of all labelled texts, dealt to tasks whose sums are averaged after each pass (:func:`labelled.mixed`)."""

    def one_pass(models: list[np.ndarray], found: pd.DataFrame, turn: int) -> list[np.ndarray]:
        return [_train(models[0], found["text"].tolist(), found["y"].to_numpy())]

    return _model(labelled.mixed(rows, [_start()], one_pass, passes)[0])


def scoring(model: Model):
    """An Arrow function from texts to scores."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [model.scores(run) for run in ta.runs(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score


def quality(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", per_class: int | None = None, threshold: float = 0.5) -> DataFrame:
    """docs with held_out, score (the higher, the likelier label 1) and predicted added to each row.

    The model learns from all labelled documents (labels has doc_id and the label) for which held_out, a condition on
    doc_id, does not hold, or from ``per_class`` of each class in one task if asked to; the choice is stable. Scores follow from the text alone. A null
    or empty text gets the score of the constant. Repeated rows have equal scores; columns of docs with the names of the
    added ones are replaced, others are kept.
    """
    if per_class is None:
        model = learn_all(labelled.dealt(docs, labels, label, ~held_out))
    else:
        model = labelled.learned(labelled.sample(docs, labels, label, ~held_out, per_class), lambda texts, y, _: learn(texts, y))
    scored = docs.withColumns({"held_out": held_out, "score": scoring(model)(F.col("text").cast("string"))})
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
