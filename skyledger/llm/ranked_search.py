"""Ranked lexical search by per-term geometric blocks.

Documents are dealt to shards of at most ``SHARD_DOCS``. In a shard the posting list of every query term is clustered by
the similarity of its documents into blocks, and a block keeps a summary: for each term that some query has together
with the list's own, the largest impact among its documents. A query walks the lists of its terms, and a block is skipped
only if the exact bound of its summary, over the terms not walked yet, is below the score that the query's last place has
by then. What is not skipped is scored in full, so the results are those of scoring all documents.

Only the terms of the queries are indexed. Queries are taken in blocks of about ``TERMS_A_PASS`` terms, which bounds what
is sent to the executors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm import text_arrays as ta
from skyledger.llm.durable import durable

#: Documents of a shard; its matrix of documents by query terms is held by one task.
SHARD_DOCS = 2048
TERMS_A_PASS = 8192
#: Documents that a block is meant to hold, and values of the sketch by which documents of a list are compared.
BLOCK_DOCS, SKETCH = 64, 32
#: About so many documents are searched first, for scores that the last places have at least.
FIRST_DOCS = 20_000
#: Between terms stand all ASCII characters but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000


class Queries(NamedTuple):
    """Some queries: the vocabulary, and for each query its terms, how often it has them, and their weights."""

    vocabulary: list[bytes]
    terms: list[np.ndarray]
    counts: list[np.ndarray]
    weights: np.ndarray

    def together(self) -> list[np.ndarray]:
        """For each term the terms that some query has with it, itself included, in order."""
        met: list[set[int]] = [set() for _ in self.vocabulary]
        for own in self.terms:
            for t in own.tolist():
                met[t].update(own.tolist())
        return [np.array(sorted(m), np.int64) for m in met]


def _terms(batch: pa.Array, vocabulary: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For every run of texts its first row, the number of terms of each text, and (text, term, times) of known terms."""
    for run in ta.runs(batch):
        inside = ta.LETTERS[run.data]
        starts, ends = ta.word_spans(run, inside)
        counts = np.diff(np.searchsorted(starts, run.offsets))
        edges = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        letters = np.ascontiguousarray(ta.FOLD[run.data[inside]])
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(letters)])
        found = pc.index_in(words, value_set=vocabulary)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        texts = np.repeat(np.arange(run.count), counts)[known]
        code, times = np.unique(texts * len(vocabulary) + found.drop_null().to_numpy().astype(np.int64), return_counts=True)
        yield run.first, counts, code // max(len(vocabulary), 1), code % max(len(vocabulary), 1), times


def _counter(sent, names: list[str]):
    def count_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(sent.value, pa.binary())
        for batch in batches:
            for first, counts, text, term, times in _terms(batch.column("text"), vocabulary):
                begins = pa.array(np.searchsorted(text, np.arange(len(counts) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(begins, pa.array(v, pa.int32())) for v in (term, times)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(counts)), pa.array(counts, pa.int64()), *lists], names=names)

    return count_all


def term_counts(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (all terms of the text), and the places of known terms in the vocabulary (terms) with their times."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    own = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ints = F.array().cast("array<int>")
    schema = own.select("doc_id", F.lit(0).cast("long").alias("n"), ints.alias("terms"), ints.alias("times")).schema
    return own.mapInArrow(_counter(sent, schema.names), schema)


class Shard:
    """Documents as a matrix of impacts by query terms, and the blocks of every term's posting list.

    ``members`` has the documents of all blocks, list by list; ``blocks`` where each block begins there, ``lists`` where
    the blocks of each term begin, and ``summaries`` for each block the largest impacts over the terms met with its own.
    """

    def __init__(self, impacts: np.ndarray, members: np.ndarray, blocks: np.ndarray, lists: np.ndarray, summaries: np.ndarray):
        self.impacts, self.members, self.blocks, self.lists, self.summaries = impacts, members, blocks, lists, summaries

    @classmethod
    def build(cls, impacts: np.ndarray, weights: np.ndarray, together: list[np.ndarray]) -> Shard:
        # documents are compared by a sketch of their weighted impacts, of length one
        signs = np.random.default_rng(5).choice(np.array([-1, 1], np.float32), (impacts.shape[1], SKETCH))
        sketch = impacts.astype(np.float32) @ (signs * weights[:, None].astype(np.float32))
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        members, blocks, lists, summaries = [], [], [0], []
        placed, made = 0, 0
        for t, met in enumerate(together):
            own = np.flatnonzero(impacts[:, t])
            if len(own):
                n = -(-len(own) // BLOCK_DOCS)
                nearest = np.argmax(sketch[own] @ sketch[own[np.arange(n) * len(own) // n]].T, axis=1)
                order = np.argsort(nearest, kind="stable")
                own, nearest = own[order], nearest[order]
                begins = np.flatnonzero(np.append(True, nearest[1:] != nearest[:-1]))
                summaries.append(np.maximum.reduceat(impacts[np.ix_(own, met)], begins, axis=0).ravel())
                members.append(own)
                blocks.append(begins + placed)
                placed += len(own)
                made += len(begins)
            lists.append(made)
        whole = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int32)
        return cls(impacts, whole(members), np.append(whole(blocks), placed).astype(np.int32), np.array(lists, np.int32), whole(summaries))

    def search(self, queries: Queries, together: list[np.ndarray], least: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query with results its number, the documents of its first k places and their scores.

        ``least`` are scores that the last place of each query has at least. Equal scores stand in the order of documents.
        """
        sizes = np.diff(self.lists) * np.array([len(m) for m in together], np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)])
        for q, (terms, counts) in enumerate(zip(queries.terms, queries.counts)):
            worth = counts * queries.weights[terms]
            here = (np.diff(self.lists)[terms] > 0) & (worth > 0)
            terms, worth = terms[here], worth[here]
            if not len(terms):
                continue
            tables = [self.summaries[at[t] : at[t + 1]].reshape(-1, len(together[t])) for t in terms.tolist()]
            most = np.array([table[:, np.searchsorted(together[t], t)].max() for t, table in zip(terms.tolist(), tables)], np.int64) * worth
            walk = np.argsort(-most, kind="stable")
            rest = np.cumsum(most[walk][::-1])[::-1]
            bar, seen = max(int(least[q]), 1), np.zeros(len(self.impacts), bool)
            docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for i, j in enumerate(walk.tolist()):
                if rest[i] < bar:
                    break
                # no document of this list that has a term walked before is new, so these terms add nothing to the bound
                left = walk[i:]
                t = int(terms[j])
                bounds = tables[j][:, np.searchsorted(together[t], terms[left])].astype(np.int64) @ worth[left]
                alive = np.flatnonzero(bounds >= bar) + self.lists[t]
                if not len(alive):
                    continue
                new = np.concatenate([self.members[self.blocks[b] : self.blocks[b + 1]] for b in alive.tolist()])
                new = new[~seen[new]]
                if not len(new):
                    continue
                seen[new] = True
                found = self.impacts[np.ix_(new, terms)].astype(np.int64) @ worth
                good = found >= bar
                docs, scores = np.append(docs, new[good]), np.append(scores, found[good])
                if len(docs) > k:
                    best = np.lexsort((docs, -scores))[:k]
                    docs, scores = docs[best], scores[best]
                    bar = max(bar, int(scores[-1]))
            if len(docs):
                best = np.lexsort((docs, -scores))[:k]
                yield q, docs[best], scores[best]


def _impacts(n: np.ndarray, text: np.ndarray, term: np.ndarray, times: np.ndarray, width: int, documents: int, length: int) -> np.ndarray:
    """The matrix of impacts of some documents."""
    out = np.zeros((len(n), width), np.int32)
    slope = 25 + 75 * n * documents // max(length, 1)
    out[text, term] = SCALE * times // (1000 * times + 8 * slope[text])
    return out


PARTS = ("text", "term", "impact", "members", "blocks", "lists", "summaries")


def _builder(sent, documents: int, length: int, names: list[str]):
    def build_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        together = queries.together()
        for batch in batches:
            for first in range(0, len(batch), SHARD_DOCS):
                rows = pa.Table.from_batches([batch.slice(first, SHARD_DOCS)]).sort_by("doc_id").combine_chunks()
                terms, times = (rows.column(c).combine_chunks() for c in ("terms", "times"))
                text = np.repeat(np.arange(len(rows)), pc.list_value_length(terms).to_numpy())
                term, times = terms.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
                impacts = _impacts(rows.column("n").to_numpy(), text, term, times, len(queries.vocabulary), documents, length)
                made = Shard.build(impacts, queries.weights, together)
                values = (text, term, impacts[text, term], made.members, made.blocks, made.lists, made.summaries)
                lists = [pa.array([v.astype(np.int32)], pa.list_(pa.int32())) for v in values]
                ids = rows.column("doc_id").combine_chunks()
                held = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([held, *lists], names=names)

    return build_all


def _searcher(sent, k: int, names: list[str]):
    def search_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least = sent.value
        together = queries.together()
        for batch in batches:
            for r in range(len(batch)):
                ids = batch.column("ids")[r].values
                parts = {c: batch.column(c)[r].values.to_numpy() for c in PARTS}
                impacts = np.zeros((len(ids), len(queries.vocabulary)), np.int32)
                impacts[parts["text"], parts["term"]] = parts["impact"]
                shard = Shard(impacts, *(parts[c] for c in PARTS[3:]))
                for q, docs, scores in shard.search(queries, together, least, k):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), q), pa.int32()), ids.take(pa.array(docs)), pa.array(scores, pa.int64())], names=names)

    return search_all


def build_index(counts: DataFrame, queries: Queries, documents: int, length: int) -> DataFrame:
    """The index: a row for each shard of the documents of ``term_counts``."""
    sent = counts.sparkSession.sparkContext.broadcast(queries)
    schema = T.StructType([T.StructField("ids", T.ArrayType(counts.schema["doc_id"].dataType))] + [T.StructField(c, T.ArrayType(T.IntegerType())) for c in PARTS])
    return counts.mapInArrow(_builder(sent, documents, length, schema.names), schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first k places of every query among the results of shards."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_index(index: DataFrame, queries: Queries, k: int, documents: int) -> DataFrame:
    """The first k documents of every query (q, its number): q, rank, doc_id and score."""
    spark = index.sparkSession
    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("doc_id", index.schema["ids"].dataType.elementType), T.StructField("score", T.LongType())])

    def over(some: DataFrame, least: np.ndarray) -> DataFrame:
        sent = spark.sparkContext.broadcast((queries, least))
        return _best(some.mapInArrow(_searcher(sent, k, schema.names), schema), k)

    least = np.zeros(len(queries.terms), np.int64)
    parts = documents // FIRST_DOCS
    if parts > 1:
        # any k documents give a score that the last place has at least; these are a stable choice of shards
        some = index.filter(F.pmod(F.xxhash64("ids"), F.lit(parts)) == 0)
        for row in over(some, least).filter(F.col("rank") == k).select("q", "score").collect():
            least[row["q"]] = row["score"]
    return over(index, least)


def _numbered(rows: list, weights: dict[bytes, int] | None = None) -> Queries:
    """Queries of collected rows with their terms."""
    vocabulary = sorted({t.encode() for r in rows for t in r["terms"]})
    place = {t: i for i, t in enumerate(vocabulary)}
    pairs = [np.unique([place[t.encode()] for t in r["terms"]], return_counts=True) for r in rows]
    return Queries(vocabulary, [p.astype(np.int64) for p, _ in pairs], [c.astype(np.int64) for _, c in pairs], np.zeros(len(vocabulary), np.int64))


def _weight(documents: int, having: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k documents of the highest scores for every item: item_id, rank (from 1), doc_id and score.

    docs has doc_id and text, items item_id and text; other columns are not read and may have any name. Terms are the
    longest stretches of ASCII digits and letters and of all characters beyond ASCII, with A-Z in lower case. A term's
    weight is floor(1000 ln((2N + 2) / (2 df + 1))) for N documents with terms, df of them with this one; a document with
    n terms, of all L, has the slope m = 25 + 75 n N div L, and its score sums weight * (10^9 tf div (1000 tf + 8 m)) over
    the item's terms, repeats included, in integers.

    Documents of score 0 are not returned, so a null or empty text is never found and such an item finds nothing. Equal
    scores stand by ascending doc_id, a missing one last. Rows of docs and of items may repeat; each counts on its own.
    """
    lowered = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.filter(F.split(lowered, BETWEEN), lambda w: w != "")
    asked = durable(items.select(F.col("item_id").alias("item_id"), terms.alias("terms")).filter("size(terms) > 0").withColumn("_row", F.monotonically_increasing_id()))
    load = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes = max(-(-load // TERMS_A_PASS), 1)
    parts = [_pass(docs, asked.filter(F.pmod(F.xxhash64("_row"), F.lit(passes)) == i), k) for i in range(passes)]
    return reduce(DataFrame.unionByName, parts)


def _pass(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The results of one block of items."""
    spark = docs.sparkSession
    rows = asked.orderBy("_row").collect()
    queries = _numbered(rows)
    counts = durable(term_counts(docs, queries.vocabulary))
    totals = counts.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    having = counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()
    for row in having:
        queries.weights[row["t"]] = _weight(totals["documents"], row["df"])
    index = durable(build_index(counts, queries, totals["documents"], totals["length"]))
    found = search_index(index, queries, k, totals["documents"])
    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("item_id", asked.schema["item_id"].dataType)])
    named = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(rows)], schema)
    return found.join(named, "q").select("item_id", "rank", "doc_id", "score")
