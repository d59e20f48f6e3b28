"""Labelled documents to learn from, and the hold-out that no model learns from."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.llm.durable import durable
from skyledger.llm.stable_order import rank

#: Texts that one task learns from, on average.
TASK_TEXTS = 8_192
#: Changes are summed as whole numbers of this fraction, so that their mean does not depend on the order of the tasks.
_UNIT = float(1 << 24)


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of doc_id as text, modulo ``parts``; a null is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def _known(labels: DataFrame, label: str, learn: Column) -> DataFrame:
    """The labels to learn from: each doc_id with each of its values (y, 0 or 1) once, and its place in the order (r)."""
    known = labels.filter(learn & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("y")).distinct()
    return known.withColumn("r", rank("learn", F.col("doc_id")))


def _texts(docs: DataFrame, with_column: str | None) -> DataFrame:
    return docs.filter("doc_id is not null and text is not null").select(
        "doc_id", F.col("text").cast("string").alias("text"), (F.col(with_column) if with_column in docs.columns else F.lit(None)).cast("string").alias("more")
    )


def _one_text(found: Column) -> Column:
    """Of the texts of one document (structs of text and more) always the same."""
    return F.min_by(found, F.when(found.isNotNull(), F.struct(F.xxhash64(found["text"]), F.length(found["text"]), found["more"])))


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, with_column: str | None = None) -> DataFrame:
    """Texts and labels (y, 0 or 1), and values of a further column (more) if one is named, of at most ``per_class``
    documents of each class, with their place in a stable pseudo-random order (r, then doc_id, y and text).

    The ids are chosen among the labels first, so the sample has a fixed bound and is sent to the documents, not they to
    it. Of rows that repeat a doc_id, labels count once for each value, and of documents one text is taken, the same in
    every run. Labels without doc_id or value are not used; nor are documents without a text.
    """
    known = _known(labels, label, learn)
    chosen = [known.filter(F.col("y") == y).orderBy("r", "doc_id").limit(per_class) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).select(F.col("doc_id").alias("_id"), "y", "r")
    found = _texts(docs, with_column).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    one = _one_text(F.struct("text", "more")).alias("one")
    return found.groupBy("r", "doc_id", "y").agg(one).select("r", "doc_id", "y", "one.text", "one.more")


def dealt(docs: DataFrame, labels: DataFrame, label: str, learn: Column, with_column: str | None = None) -> DataFrame:
    """The rows of :func:`sample` for all labels, dealt to tasks by doc_id, some TASK_TEXTS for each, and stored.

    Their number follows from the labels alone, so that what the tasks learn is the same on any cluster. Texts and labels
    are shuffled once, together, as the rows are to lie.
    """
    known = _known(labels, label, learn)
    tasks = max(math.ceil(known.count() / TASK_TEXTS), 1)
    texts = _texts(docs.filter(learn), with_column).select("doc_id", F.struct("text", "more").alias("one"))
    both = texts.unionByName(known.select("doc_id", "y"), allowMissingColumns=True).repartition(tasks, "doc_id")
    rows = both.groupBy("doc_id").agg(_one_text(F.col("one")).alias("one"), F.max(F.col("y") == 0).alias("clean"), F.max(F.col("y") == 1).alias("marked"))
    classes = F.filter(F.array(F.when(F.col("clean"), 0), F.when(F.col("marked"), 1)), lambda y: y.isNotNull())
    rows = rows.filter("one is not null").select(rank("learn", F.col("doc_id")).alias("r"), "doc_id", F.explode(classes).alias("y"), "one.text", "one.more")
    return durable(rows)


def _in_order(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> pd.DataFrame:
    return pa.Table.from_batches(list(batches), schema).to_pandas().sort_values(["r", "doc_id", "y", "text"])


def by_task(rows: DataFrame, make: Callable[[pd.DataFrame], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``make`` finds in the rows of each task that has any."""
    kind = to_arrow_schema(rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _in_order(batches, kind)
        if len(found):
            yield make(found)

    return rows.mapInArrow(run, schema)


def mixed(rows: DataFrame, models: list[np.ndarray], one_pass: Callable[[list[np.ndarray], pd.DataFrame, int], list[np.ndarray]], passes: int) -> list[np.ndarray]:
    """Models, each a table of numbers, after some passes over all rows: iterative parameter mixing.

    In each pass every task goes on from the same models over its own rows (``one_pass``, with the number of the pass), and
    each row of a model moves by the mean change of the tasks that changed it. The tasks' changes are averaged by shuffle;
    only the models come to the driver, whatever the number of rows.
    """
    width = models[0].shape[1]
    values = [f"v{i}" for i in range(width)]
    schema = "model int, at int, " + ", ".join(f"{v} long" for v in values)
    models = [m.astype(np.float32) for m in models]
    for turn in range(passes):
        sent = rows.sparkSession.sparkContext.broadcast(models)

        def changes(found: pd.DataFrame, turn: int = turn, sent: Broadcast = sent) -> pa.RecordBatch:
            was = [m.astype(np.float64) for m in sent.value]
            moved = [now - m for now, m in zip(one_pass([m.copy() for m in was], found, turn), was)]
            at = [np.flatnonzero(m.any(axis=1)) for m in moved]
            steps = np.rint(np.concatenate([m[i] for m, i in zip(moved, at)]) * _UNIT).astype(np.int64)
            keys = [np.repeat(np.arange(len(at)), [len(i) for i in at]).astype(np.int32), np.concatenate(at).astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in [*keys, *steps.T]], ["model", "at", *values])

        mean = [(F.sum(v) / F.count("*") / _UNIT).cast("float").alias(v) for v in values]
        got = by_task(rows, changes, schema).groupBy("model", "at").agg(*mean).toArrow()
        sent.destroy()
        model, at = got["model"].to_numpy(), got["at"].to_numpy()
        # in place and column by column, since the driver has little memory
        for k, m in enumerate(models):
            own = model == k
            for i, v in enumerate(values):
                m[at[own], i] += got[v].to_numpy()[own]
        del got, model, at
    return [m.astype(np.float64) for m in models]


def learned(rows: DataFrame, learn: Callable[[list[str], np.ndarray, list[str | None]], Any]) -> Any:
    """What ``learn`` makes of the texts, labels and further values of a sample, in one task; only its result is collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _in_order(batches, schema)
        more = found["more"].where(found["more"].notna(), None).tolist()
        yield pa.RecordBatch.from_pydict({"made": [pickle.dumps(learn(found["text"].tolist(), found["y"].to_numpy(np.int64), more))]})

    schema = to_arrow_schema(rows.schema)
    made = rows.repartition(1).mapInArrow(run, "made binary").collect()
    return pickle.loads(made[0]["made"]) if made else learn([], np.zeros(0, np.int64), [])


def as_column(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.large_string())
