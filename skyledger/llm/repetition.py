"""Quality rules on repetition: how much of a text stands in words, n-grams and lines that it repeats."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import text_arrays as ta

SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
#: The largest share of a text's characters that may stand in later copies of n-grams of a length. A text that says a
#: line twice passes; one that is for a quarter and more a copy of itself does not.
NGRAM_SHARES = {5: 0.30, 8: 0.27, 10: 0.25}
#: The same for later copies of lines.
LINE_SHARE = 0.25
FEWEST_WORDS = 50
WINDOW = 3

SCHEMA = (
    "doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_share double, " + ", ".join(f"dup_{n}gram_share double" for n in NGRAM_SHARES) + ", base_failed boolean, kept boolean"
)


@dataclass
class Repeated:
    """Of some stretches: whether each occurs again in its text, and whether an equal one came before it."""

    again: np.ndarray
    later: np.ndarray


def repeated(keys: np.ndarray, text: np.ndarray) -> Repeated:
    """Marks stretches whose key occurs more than once in their text."""
    with np.errstate(over="ignore"):
        own = ta.mix(keys + ta.mix(text.astype(np.uint64)))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    again, later = np.zeros(len(own), bool), np.zeros(len(own), bool)
    again[order[1:]] = same
    later[order[1:]] = same
    again[order[:-1]] |= same
    return Repeated(again, later)


def covered_words(w: ta.Words, length: int, first_too: bool) -> np.ndarray:
    """Marks words inside an n-gram of ``length`` words that its text holds twice or more; inside later copies only, or in the first too."""
    n = len(w.hashes)
    total = max(n - length + 1, 0)
    out = np.zeros(n, bool)
    if not total:
        return out
    rolled = np.zeros(total, np.uint64)
    for k, factor in enumerate(ta.seeds(length, 31)):
        rolled += w.hashes[k : k + total] * factor
    text = w.text_of_word()
    inside = np.flatnonzero(text[:total] == text[length - 1 :])
    found = repeated(rolled[inside], text[inside])
    twice = inside[found.again if first_too else found.later]
    # a running sum of begins and ends gives the words under any of these windows
    edges = np.zeros(n + 1, np.int64)
    edges[twice] += 1
    edges[twice + length] -= 1
    return np.cumsum(edges[:-1]) > 0


def measures(run: ta.Run) -> dict[str, np.ndarray]:
    """The counts and shares of every text of a run."""
    w = ta.words(run, ~ta.WHITE)
    first = ta.code_points(run.data)
    points = np.concatenate([[0], np.cumsum(first & w.inside)])
    size = points[w.ends] - points[w.starts]  # code points of each word
    chars = points[run.offsets[1:]] - points[run.offsets[:-1]]
    out = {
        "n_words": w.counts.astype(np.int64),
        "word_chars": chars.astype(np.int64),
        "n_symbols": ta.sum_by_text(SYMBOLS[run.data], run.offsets),
        "n_repeat_words": ta.sum_by_text(covered_words(w, WINDOW, True), w.at),
    }
    line_at, line_ends = ta.word_spans(run, run.data != 0x0A)
    worded = points[line_ends] > points[line_at]
    line_at, line_ends = line_at[worded], line_ends[worded]
    text = np.searchsorted(run.offsets, line_at, "right") - 1
    lines = repeated(ta.Prefix(run.data).hashes(line_at, line_ends), text)
    whole = np.maximum(chars, 1)
    out["n_dup_lines"] = np.bincount(text[lines.later], minlength=run.count).astype(np.int64)
    held = (points[line_ends] - points[line_at]) * lines.later
    out["dup_line_share"] = np.bincount(text, weights=held, minlength=run.count) / whole
    for length in NGRAM_SHARES:
        out[f"dup_{length}gram_share"] = ta.sum_by_text(size * covered_words(w, length, False), w.at) / whole
    return out


def verdict(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which texts fail the base rules, and which are kept by base rules and coverage."""
    failed = (m["n_words"] < FEWEST_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    kept = ~failed & (m["dup_line_share"] <= LINE_SHARE)
    for length, share in NGRAM_SHARES.items():
        kept &= m[f"dup_{length}gram_share"] <= share
    return failed, kept


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in ta.runs(batch.column("text")):
            m = measures(run)
            failed, kept = verdict(m)
            columns = {"doc_id": batch.column("doc_id").slice(run.first, run.count)}
            columns |= {k: pa.array(m[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_share")}
            columns |= {f"dup_{n}gram_share": pa.array(m[f"dup_{n}gram_share"]) for n in NGRAM_SHARES}
            yield pa.RecordBatch.from_pydict(columns | {"base_failed": pa.array(failed), "kept": pa.array(kept)})


def judge(docs: DataFrame) -> DataFrame:
    """Measures and verdict for every row of docs (doc_id, text).

    Words are stretches without white space, case kept. n_repeat_words counts words in three-word windows that the text
    holds twice or more; n_dup_lines lines with a word that equal an earlier one; the shares are of the characters of
    words: in later copies of lines, and in later copies of n-grams of five, eight and ten words. A document is kept if it passes the base rules (50 words, at most half of them repeated) and no share is above its
    limit.

    Null and empty texts have zeros throughout and fail the base rules. Each row is judged by itself, whatever its
    doc_id; other columns are not read.
    """
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_judge, SCHEMA.format(id=own.schema["doc_id"].dataType.simpleString()))
