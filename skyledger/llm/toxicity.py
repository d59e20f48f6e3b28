"""Toxicity scores by a convolutional network over hashed word embeddings.

A word's vector is the sum of learned vectors for the hashes of the word and of its beginnings, so that forms of one stem
share what they have in common. Filters over one, two and three words are max-pooled over the whole text and weighed by a
logistic unit. The first filter starts from how much likelier a word or a beginning is in toxic texts, the rest from
small random values; all is trained in numpy by stochastic gradients, by tasks that each hold a part of the labelled texts
and whose networks are averaged after every pass.
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

BITS = 16
#: Lengths of the beginnings of a word, in characters; a word has those that are shorter than itself.
STEMS = (4, 5, 6, 7, 8)
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 4
PASSES = 4
BATCH = 32
RATE = 0.05
#: The share of toxic texts for which scores are probabilities.
TOXIC_SHARE = 0.1
#: Pseudo-texts with and without a word, by which the start values are smoothed, and by which those of rare words shrink.
SMOOTH, SHRINK = 3.0, 5.0
THRESHOLD = 0.3
#: Languages with fewer labelled texts of either class keep the common threshold.
LEAST_FOR_LANGUAGE = 20

#: Log odds of texts not learned from are told apart by this fraction when curve and thresholds are laid through them.
VALUE_UNIT = 1024

_PAD = 1 << BITS
_GAP = max(WIDTHS) - 1
#: Column range of each (width, place in the window) among the products of a word.
_COLUMNS = {}
for _w in WIDTHS:
    for _k in range(_w):
        _COLUMNS[_w, _k] = slice(len(_COLUMNS) * FILTERS, (len(_COLUMNS) + 1) * FILTERS)


@dataclass
class Stream:
    """Words of some texts, each as rows of the table, with padding after each text, and where each text's windows begin and end."""

    rows: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def stream(run: ta.Run) -> Stream:
    inside = ta.LETTERS[run.data]
    starts, ends = ta.word_spans(run, inside)
    prefix = ta.Prefix(run.data, ta.FOLD)
    at = np.searchsorted(starts, run.offsets)
    n = np.diff(at)
    begin = at[:-1] + _GAP * np.arange(run.count) + np.concatenate([[0], np.cumsum(n == 0)[:-1]])
    total = int(begin[-1] + max(n[-1], 1) + _GAP)
    place = np.arange(len(starts)) + np.repeat(begin - at[:-1], n)
    shift = np.uint64(64 - BITS)
    rows = np.full((1 + len(STEMS), total), _PAD, np.int32)
    rows[0, place] = (prefix.hashes(starts, ends) >> shift).astype(np.int32)
    points = np.flatnonzero(ta.code_points(run.data))
    first = np.searchsorted(points, starts)
    for k, length in enumerate(STEMS, 1):
        beyond = first + length
        stop = np.where(beyond < len(points), points[np.minimum(beyond, len(points) - 1)], len(run.data)) if len(points) else ends
        own = stop < ends
        rows[k, place[own]] = (prefix.hashes(starts[own], stop[own]) >> shift).astype(np.int32)
    return Stream(rows, begin, begin + np.maximum(n, 1))


@dataclass
class Network:
    """The table of vectors (the last row is padding), filters by width, their offsets and the last unit."""

    table: np.ndarray
    filters: dict[int, np.ndarray]
    offsets: np.ndarray
    last: np.ndarray
    constant: float
    #: How the last unit's value becomes log odds.
    slope: float = 1.0
    shift: float = 0.0

    def products(self) -> np.ndarray:
        """For every row of the table its part of each filter at each place in the window."""
        return (self.table @ np.concatenate([self.filters[w][k] for w, k in _COLUMNS], axis=1)).astype(np.float32)

    def pooled(self, s: Stream, products: np.ndarray) -> np.ndarray:
        """The largest value of every filter over each text."""
        words = products[s.rows[0]]
        for own in s.rows[1:]:
            some = np.flatnonzero(own != _PAD)
            words[some] += products[own[some]]
        out = []
        edges = np.stack([s.begin, s.end], axis=1).ravel()
        total = s.rows.shape[1] - _GAP
        for w in WIDTHS:
            values = words[:total, _COLUMNS[w, 0]].copy()
            for k in range(1, w):
                values += words[k : total + k, _COLUMNS[w, k]]
            out.append(np.maximum.reduceat(values, edges[edges < total], axis=0)[::2])
        return np.concatenate(out, axis=1)

    def scores(self, s: Stream, products: np.ndarray) -> np.ndarray:
        value = np.maximum(self.pooled(s, products) + self.offsets, 0) @ self.last + self.constant
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -60, 60)))


def _rarity(share: float) -> float:
    """The weight of a clean text if TOXIC_SHARE of all texts are to be toxic, where ``share`` of them are."""
    return (1 / TOXIC_SHARE - 1) * share / (1 - share)


def _streams(texts: list[str]) -> list[np.ndarray]:
    """The rows of the table for the words of each text, with padding after it."""
    out = []
    for run in ta.runs(labelled.as_column(texts), ta.SMALL_RUN_BYTES):
        s = stream(run)
        out += [s.rows[:, b : e + _GAP] for b, e in zip(s.begin, s.end)]
    return out


def _seen(streams: list[np.ndarray]) -> np.ndarray:
    """The number of texts with a word or beginning, by table row; that of the padding counts all texts."""
    out = np.zeros(_PAD + 1, np.int64)
    for rows in streams:
        out[np.unique(rows)] += 1
    return out


def _odds(seen: np.ndarray) -> np.ndarray:
    """Log odds that a text with a word or beginning is toxic against one without, by table row; nearer 0 for rare ones.

    ``seen`` counts the clean and the toxic texts with each.
    """
    count = np.maximum(seen[:, _PAD], 1)
    share = [(seen[k] + SMOOTH * count[k] / sum(count)) / (count[k] + SMOOTH) for k in (0, 1)]
    n = seen[0] + seen[1]
    odds = (np.log(share[1]) - np.log(share[0])) * n / (n + SHRINK)
    odds[_PAD] = 0
    return odds


def _start(seen: np.ndarray, seed: int) -> Network:
    """The network that training starts from; without both classes, one that gives every text the same score."""
    dice = np.random.default_rng(seed)
    net = Network(
        dice.normal(0, 0.05, (_PAD + 1, SIZE)), {w: dice.normal(0, 0.2, (w, SIZE, FILTERS)) for w in WIDTHS},
        np.zeros(FILTERS * len(WIDTHS)), dice.normal(0, 0.1, FILTERS * len(WIDTHS)), -3.0,
    )
    net.table[_PAD] = 0
    count = seen[:, _PAD]
    if not count.all():
        net.last[:] = 0
        net.constant = 5.0 * (2 * float(count[1] / count.sum()) - 1) if count.any() else 0.0
        return net
    net.table[:, 0] = _odds(seen)
    net.filters[1][0, :, 0] = 0
    net.filters[1][0, 0, 0] = 1.0
    net.offsets[0], net.last[0] = -2.0, 0.7
    return net


def _squares() -> Network:
    """What gradients are divided by the root of, their running square sums, in the shape of a network."""
    size = FILTERS * len(WIDTHS)
    return Network(np.full((_PAD + 1, SIZE), 0.1), {w: np.full((w, SIZE, FILTERS), 0.1) for w in WIDTHS}, np.full(size, 0.1), np.full(size, 0.1), 0.1)


def _packed(net: Network) -> np.ndarray:
    """The numbers of a network as rows of SIZE: its table and then all others."""
    rest = np.concatenate([*[net.filters[w].ravel() for w in WIDTHS], net.offsets, net.last, [net.constant]])
    return np.concatenate([net.table, np.append(rest, np.zeros(-len(rest) % SIZE)).reshape(-1, SIZE)])


def _unpacked(numbers: np.ndarray) -> Network:
    rest, size, filters = numbers[_PAD + 1 :].ravel(), FILTERS * len(WIDTHS), {}
    for w in WIDTHS:
        filters[w], rest = rest[: w * SIZE * FILTERS].reshape(w, SIZE, FILTERS).copy(), rest[w * SIZE * FILTERS :]
    return Network(numbers[: _PAD + 1].copy(), filters, rest[:size].copy(), rest[size : 2 * size].copy(), float(rest[2 * size]))


def _train(net: Network, squares: Network, streams: list[np.ndarray], y: np.ndarray, rarity: float, order: np.ndarray) -> None:
    """One pass over texts in an order: the network and the square sums are changed after every batch."""
    for batch in np.array_split(order, max(len(order) // BATCH, 1)):
        rows = np.concatenate([streams[i] for i in batch], axis=1)
        n = np.array([streams[i].shape[1] - _GAP for i in batch])
        begin = np.cumsum(n + _GAP) - n - _GAP
        text = np.repeat(np.arange(len(batch)), n)
        window = np.arange(len(text)) + np.repeat(begin - np.cumsum(n) + n, n)
        vectors = net.table[rows[0]]
        for own in rows[1:]:
            some = np.flatnonzero(own != _PAD)
            vectors[some] += net.table[own[some]]
        first = np.cumsum(n) - n
        tops, values = [], []
        for w in WIDTHS:
            conv = sum((vectors @ net.filters[w][k])[window + k] for k in range(w))
            top = np.maximum.reduceat(conv, first, axis=0)
            at = np.empty((len(batch), FILTERS), np.int64)
            for f in range(FILTERS):
                hit = np.flatnonzero(conv[:, f] == top[text, f])[::-1]
                at[text[hit], f] = window[hit]  # of equal ones the first
            tops.append(at)
            values.append(top)
        raw = np.concatenate(values, axis=1) + net.offsets
        hidden = np.maximum(raw, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ net.last + net.constant, -30, 30)))
        d = (p - y[batch]) * np.where(y[batch] == 1, 1.0, rarity) / len(batch)
        back = d[:, None] * net.last * (raw > 0)
        by_filter = {w: np.zeros_like(net.filters[w]) for w in WIDTHS}
        touched, slopes = [], []
        for j, w in enumerate(WIDTHS):
            for f in range(FILTERS):
                g = back[:, j * FILTERS + f]
                some = np.flatnonzero(g)
                for k in range(w):
                    at = tops[j][some, f] + k
                    by_filter[w][k, :, f] = g[some] @ vectors[at]
                    touched.append(rows[:, at].ravel())
                    slopes.append(np.tile(g[some, None] * net.filters[w][k, :, f], (len(rows), 1)))
        for name, g in (("last", d @ hidden), ("offsets", back.sum(axis=0)), ("constant", d.sum())):
            setattr(squares, name, getattr(squares, name) + g**2)
            setattr(net, name, getattr(net, name) - RATE * g / np.sqrt(getattr(squares, name)))
        for w in WIDTHS:
            squares.filters[w] += by_filter[w] ** 2
            net.filters[w] -= RATE * by_filter[w] / np.sqrt(squares.filters[w])
        at, g = np.concatenate(touched), np.concatenate(slopes)
        own, place = np.unique(at[at != _PAD], return_inverse=True)
        total, square = np.zeros((2, len(own), SIZE))
        np.add.at(total, place, g[at != _PAD])
        np.add.at(square, place, g[at != _PAD] ** 2)
        squares.table[own] += square
        net.table[own] -= RATE * total / np.sqrt(squares.table[own])


def learn(texts: list[str], y: np.ndarray, passes: int = PASSES, seed: int = 5) -> Network:
    """A network from texts and their labels in one place; without both classes it gives every text the same score."""
    streams = _streams(texts)
    net = _start(np.stack([_seen([s for s, label in zip(streams, y) if label == k]) for k in (0, 1)]), seed)
    if len(set(y.tolist())) < 2:
        return net
    squares, order, dice = _squares(), np.arange(len(streams)), np.random.default_rng(seed)
    for _ in range(passes):
        dice.shuffle(order)
        _train(net, squares, streams, y, _rarity(y.mean()), order)
    return net


def _counted(rows: DataFrame) -> np.ndarray:
    """For each half of the texts, each label and each table row the number of texts with it."""

    def count(found: pd.DataFrame) -> pa.RecordBatch:
        streams, part = _streams(found["text"].tolist()), (2 * (found["r"] % 2) + found["y"]).to_numpy()
        seen = np.stack([_seen([streams[i] for i in np.flatnonzero(part == k)]) for k in range(4)])
        at = np.flatnonzero(seen.any(axis=0))
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *[pa.array(c) for c in seen[:, at]]], ["at", "a", "b", "c", "d"])

    got = labelled.by_task(rows, count, "at int, a long, b long, c long, d long").groupBy("at").agg(*[F.sum(c).alias(c) for c in "abcd"]).toArrow()
    out = np.zeros((4, _PAD + 1), np.int64)
    out[:, got["at"].to_numpy()] = [got[c].to_numpy() for c in "abcd"]
    return out.reshape(2, 2, -1)


def _values(rows: DataFrame, nets: list[Network]) -> pd.DataFrame:
    """How many texts of each language and label have each value (log odds in VALUE_UNIT-ths), each half by its own network."""

    def count(found: pd.DataFrame) -> pa.RecordBatch:
        half, score = found["r"].to_numpy() % 2, np.zeros(len(found))
        for k, net in enumerate(nets):
            own = half % len(nets) == k
            score[own] = text_scores(net, labelled.as_column(found["text"][own].tolist()), net.products())
        score = np.clip(score, 1e-12, 1 - 1e-12)
        value = np.rint(np.log(score / (1 - score)) * VALUE_UNIT).astype(np.int64)
        many = pd.DataFrame({"lang": found["more"].fillna("").to_numpy(), "y": found["y"].to_numpy(), "value": value}).value_counts().rename("n").reset_index()
        return pa.RecordBatch.from_pydict({"lang": pa.array(many["lang"].tolist(), pa.string()), "y": many["y"].to_numpy(np.int32), "value": many["value"].to_numpy(np.int64), "n": many["n"].to_numpy(np.int64)})

    got = labelled.by_task(rows, count, "lang string, y int, value long, n long").groupBy("lang", "y", "value").agg(F.sum("n").alias("n"))
    return got.toArrow().to_pandas().sort_values(["lang", "y", "value"])


def _curve(value: np.ndarray, y: np.ndarray, n: np.ndarray, rarity: float) -> np.ndarray:
    """Slope and shift of the logistic curve through values that n texts have."""
    x, weight, curve = np.stack([value, np.ones_like(value)], axis=1), n * np.where(y == 1, 1.0, rarity), np.array([1.0, 0.0])
    for _ in range(25):  # Newton steps, drawn to the curve that changes nothing
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (weight * (p - y)) + (curve - [1.0, 0.0])
        curve = curve - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2), slope)
    return curve


def learn_calibrated(rows: DataFrame, common: float, passes: int = PASSES) -> tuple[Network, dict[str | None, float]]:
    """A network of all labelled texts, dealt to tasks, and the thresholds of languages.

    Scores of texts learned from are too sure. So each half of the texts is scored by a network of the other half, a
    logistic curve and the thresholds are laid through the scores of all texts, and the network of all texts is given that
    curve. All counts are of all texts; the tasks' networks are averaged after each pass (:func:`labelled.mixed`).
    """
    counted = _counted(rows)
    seen = [counted.sum(axis=0), counted[1], counted[0]]  # of all texts, and of those that the half's network learns from
    halves = bool(counted[:, :, _PAD].all())
    nets, share = [], [s[1, _PAD] / max(s[:, _PAD].sum(), 1) for s in seen]

    def one_pass(models: list[np.ndarray], found: pd.DataFrame, turn: int) -> list[np.ndarray]:
        streams, y, half = _streams(found["text"].tolist()), found["y"].to_numpy(np.int64), found["r"].to_numpy() % 2
        for k, m in enumerate(models):
            net, squares = _unpacked(m[:, :SIZE]), _unpacked(m[:, SIZE:])
            order = np.flatnonzero(half != k - 1)
            if len(order):
                np.random.default_rng([turn, k]).shuffle(order)
                _train(net, squares, streams, y, _rarity(share[k]), order)
            models[k] = np.concatenate([_packed(net), _packed(squares)], axis=1)
        return models

    nets = [_start(s, 5) for s in (seen if halves else seen[:1])]
    if share[0] not in (0, 1):
        mixed = labelled.mixed(rows, [np.concatenate([_packed(net), _packed(_squares())], axis=1) for net in nets], one_pass, passes)
        nets = [_unpacked(m[:, :SIZE]) for m in mixed]
    net = nets[0]
    found = _values(rows, nets[1:] or nets)
    value, y, n = found["value"].to_numpy() / VALUE_UNIT, found["y"].to_numpy(), found["n"].to_numpy()
    if halves:
        slope, shift = _curve(value, y, n, _rarity(share[0]))
        net.slope, net.shift = max(float(slope), 1e-3), float(shift)
    scores = 1 / (1 + np.exp(-np.clip(net.slope * value + net.shift, -60, 60)))
    return net, calibrated(scores, y, found["lang"].tolist(), common, n)


def calibrated(scores: np.ndarray, y: np.ndarray, languages: list[str | None], common: float = THRESHOLD, counts: np.ndarray | None = None) -> dict[str | None, float]:
    """For each language the threshold of the best F1 on labelled texts not learned from, of equal ones the nearest to the
    common one. ``counts`` says how many texts each score stands for, one if not given."""
    out = {}
    counts = np.ones(len(y), np.int64) if counts is None else counts
    tried = np.round(np.arange(0.15, 0.601, 0.05), 2)
    languages = np.array([x if x is not None else "" for x in languages], object)
    for name in set(languages.tolist()):
        own = languages == name
        toxic, clean = counts[own] * (y[own] == 1), counts[own] * (y[own] != 1)
        if min(toxic.sum(), clean.sum()) < LEAST_FOR_LANGUAGE:
            continue

        def f1(t: float) -> float:
            hit = scores[own] >= t
            return 2 * toxic[hit].sum() / max(counts[own][hit].sum() + toxic.sum(), 1)

        out[name or None] = float(max(tried, key=lambda t: (round(f1(t), 6), -abs(t - common))))
    return out


def text_scores(net: Network, texts: pa.Array, products: np.ndarray) -> np.ndarray:
    parts = [net.scores(stream(run), products) for run in ta.runs(texts, ta.SMALL_RUN_BYTES)]
    return np.concatenate(parts) if parts else np.zeros(0)


def scoring(net: Network):
    """An Arrow function from texts to scores. The tables are sent as the products that scoring needs."""
    products = net.products()
    small = Network(np.zeros(0), {}, net.offsets, net.last, net.constant, net.slope, net.shift)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(text_scores(small, texts, products))

    return score


def trained(docs: DataFrame, labels: DataFrame, held_out: Column, label: str, threshold: float) -> tuple[Column, Column]:
    """The score of a row of docs and the threshold of its language, as columns, learned from all labelled documents."""
    net, own = learn_calibrated(labelled.dealt(docs, labels, label, ~held_out, "lang"), threshold)
    limit = F.lit(threshold)
    for name, value in sorted((k, v) for k, v in own.items() if k is not None):
        limit = F.when(F.col("lang") == name, value).otherwise(limit)
    return scoring(net)(F.col("text").cast("string")), limit


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """docs with held_out, score, predicted (score at the common threshold) and rejected added to each row.

    rejected holds the score against the threshold of the document's language, which is set on the texts learned from;
    languages with few of them, unknown and null ones have the common threshold, and so have all if docs has no lang. The
    network learns from all labelled documents (labels has doc_id and the label) for which held_out, a condition on doc_id,
    does not hold; labels and documents that repeat a doc_id count as :func:`labelled.sample` says. Scores follow from the text alone. A null or
    empty text has the score of a text without known words. Repeated rows have equal scores; columns of docs with the
    names of the added ones are replaced, others are kept.
    """
    score, limit = trained(docs, labels, held_out, label, threshold)
    scored = docs.withColumns({"held_out": held_out, "score": score})
    return scored.withColumns({"predicted": (F.col("score") >= threshold).cast("int"), "rejected": F.col("score") >= limit})


def without_toxic(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with their columns as they are, whose score is below the threshold of their language."""
    score, limit = trained(docs, labels, held_out, label, threshold)
    return docs.filter(score < limit)
