"""Alignment of the tokens of two tokenizers over the same bytes.

Both tokenizers cut the bytes of a text into tokens. Per batch, and keyed by document, an as-of merge finds for each token
start the token of the other side that covers it. Both directions together are all overlaps; overlaps whose tokens end at
the same byte are links, and these ends cut the text into groups of tokens that cover the same bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.frames import split_join
from skyledger.llm import text_arrays as ta
from skyledger.llm.byte_pairs import Merges, encode_run, tokenizers_classes
from skyledger.llm.durable import durable
from skyledger.llm.merge_replay import read_file

#: Texts are encoded on side a in blocks of about this size, and aligned in smaller ones; a longer text is a block.
ENCODED_BYTES, ALIGNED_BYTES = 8 << 20, 1 << 19


class _Pieces:
    """A sentencepiece model and the bytes of its pieces."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = pa.array([self._bytes(i) for i in range(self.model.get_piece_size())], pa.binary())

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self.model.encode(texts, out_type=int, num_threads=1)
        begins = np.concatenate([[0], np.cumsum([len(ids) for ids in lists], dtype=np.int64)])
        return np.fromiter(chain.from_iterable(lists), np.int32, begins[-1]), begins


class _Side:
    """The tokens of one side in a block: ids, the text of each, and their bytes, counted through the whole block."""

    def __init__(self, ids: np.ndarray, begins: np.ndarray, tokens: pa.Array):
        parts = tokens.take(pa.array(ids))
        self.edges = np.frombuffer(parts.buffers()[1], np.int32)[: len(parts) + 1].astype(np.int64)
        self.data = parts.buffers()[2]
        self.ids, self.begins = ids, begins

    def same(self, texts: pa.Array) -> np.ndarray:
        """Which texts the joined tokens spell."""
        offsets, view = self.edges[self.begins].tolist(), memoryview(self.data) if self.data is not None else memoryview(b"")
        wanted = texts.cast(pa.large_binary())
        return np.array([view[i:j] == w.as_buffer() for i, j, w in zip(offsets, offsets[1:], wanted)], bool)

    def kept(self, good: np.ndarray) -> pd.DataFrame:
        """The tokens of good texts, with the bytes counted through these texts only."""
        counts = np.diff(self.begins)
        mine = np.repeat(good, counts)
        size = np.diff(self.edges)[mine]
        end = np.cumsum(size)
        return pd.DataFrame({"doc": np.repeat(np.arange(len(good)), counts)[mine], "start": end - size, "end": end, "id": self.ids[mine]})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Every pair of tokens of the two sides that share a byte, once: doc, a, a_end, b, b_end.

    Both frames have doc, start, end and id, and starts that ascend through all texts.
    """
    a = a.rename(columns={"id": "a", "end": "a_end"})
    b = b.rename(columns={"id": "b", "end": "b_end"})
    covered_a = pd.merge_asof(a, b.rename(columns={"start": "b_start"}), left_on="start", right_on="b_start", by="doc")
    covered_b = pd.merge_asof(b, a.rename(columns={"start": "a_start"}), left_on="start", right_on="a_start", by="doc")
    # tokens with the same start have found each other in both directions
    covered_b = covered_b[covered_b["start"] != covered_b["a_start"]]
    columns = ["doc", "a", "a_end", "b", "b_end"]
    return pd.concat([covered_a[columns], covered_b[columns]], ignore_index=True)


def _joined(values: pa.Array, offsets: np.ndarray, by: str) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), by)


def _names(side: pd.DataFrame, cuts: np.ndarray, names: pa.Array) -> pa.Array:
    """The ids of a side as text, joined by a comma within every group."""
    offsets = np.concatenate([[0], np.searchsorted(side["end"].to_numpy(), cuts, "right")])
    return _joined(names.take(pa.array(side["id"].to_numpy())), offsets, ",")


def _aligner(sent, names: list[str]):
    def align_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, classes, model = sent.value
        merges, pieces = Merges.from_json(vocabulary), _Pieces(model)
        numbers = pa.array([str(i) for i in range(max(len(merges.tokens), len(pieces.tokens)))], pa.string())
        for batch in batches:
            for run in ta.runs(batch.column("text"), ENCODED_BYTES):
                texts = batch.column("text").slice(run.first, run.count).fill_null("")
                spaced = pc.binary_join_element_wise("", texts, " ")
                ids, begins = encode_run(merges, next(ta.runs(spaced, 1 << 62)), classes)
                for part in ta.runs(texts, ALIGNED_BYTES):
                    at = slice(part.first, part.first + part.count)
                    edges = begins[part.first : part.first + part.count + 1]
                    side = _Side(ids[edges[0] : edges[-1]], edges - edges[0], merges.tokens)
                    docs = batch.column("doc_id").slice(run.first + part.first, part.count)
                    yield pa.RecordBatch.from_arrays([docs, *_aligned(texts[at], spaced[at], side, pieces, numbers)], names=names)

    return align_all


def _aligned(texts: pa.Array, spaced: pa.Array, a: _Side, pieces: _Pieces, numbers: pa.Array) -> list[pa.Array]:
    """n_a, n_b, n_groups, groups and links of some texts, which ``spaced`` has with a blank before each."""
    n = len(texts)
    b = _Side(*pieces.encode(texts.to_pylist()), pieces.tokens)
    full = pc.not_equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    good = full & a.same(spaced) & b.same(spaced)
    left, right = a.kept(good), b.kept(good)
    met = overlaps(left, right)
    met = met[met["a_end"] == met["b_end"]].sort_values("a_end")
    docs, cuts = met["doc"].to_numpy(), met["a_end"].to_numpy()
    groups = pc.binary_join_element_wise(_names(left, cuts, numbers), _names(right, cuts, numbers), "|")
    begins = np.searchsorted(docs, np.arange(n + 1))
    # how often a text links a pair of ids
    pairs = met.assign(code=(met["a"].to_numpy(np.int64) << 32) | met["b"].to_numpy(np.int64)).groupby(["doc", "code"], sort=True).size()
    code = pairs.index.get_level_values("code").to_numpy(np.int64)
    linked = np.searchsorted(pairs.index.get_level_values("doc").to_numpy(), np.arange(n + 1))
    rows = pa.StructArray.from_arrays(
        [pa.array((code >> 32).astype(np.int32)), pa.array((code & 0xFFFFFFFF).astype(np.int32)), pa.array(pairs.to_numpy(np.int32))], names=["a", "b", "n"]
    )
    count = lambda side: pa.array(np.bincount(side["doc"].to_numpy(), minlength=n), pa.int64())
    return [
        count(left), count(right), pa.array(np.diff(begins), pa.int64()),
        _joined(groups, begins, ";"), pa.ListArray.from_arrays(pa.array(linked, pa.int32()), rows),
    ]


LINKS = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in "abn"]))


def align(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """For every text its tokens on both sides, their groups and links.

    ``vocabulary`` is a byte-level BPE file of the tokenizers library (side a, which reads a blank and the text), ``model``
    a sentencepiece model that adds a blank itself (side b). Returns doc_id, n_a, n_b and n_groups, groups (text: ids of a
    and of b, each joined by commas, with a bar between them and a semicolon between groups) and links (ids a and b of
    tokens that end at the same byte, and how often the text has them).

    docs has doc_id and text; other columns are not read and may have any name. Special tokens in a text are plain text.
    A null or empty text has no tokens, nor has one whose tokens, joined, do not spell a blank and the text on both sides,
    as when the model rewrites a character. Rows may repeat or lack a doc_id; each gives one row.
    """
    sent = docs.sparkSession.sparkContext.broadcast((read_file(vocabulary), tokenizers_classes(), read_file(model)))
    own = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    zero = F.lit(0).cast("long")
    shape = own.select("doc_id", *[zero.alias(c) for c in ("n_a", "n_b", "n_groups")], F.lit("").alias("groups"), F.lit(None).cast(LINKS).alias("links"))
    return own.mapInArrow(_aligner(sent, shape.columns), shape.schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How often the corpus links each pair of ids: a, b, count, and whether no pair with this b is linked more often."""
    counts = aligned.select(F.inline("links")).groupBy("a", "b").agg(F.sum("n").alias("count"))
    counts = durable(counts)
    best = counts.groupBy("b").agg(F.max("count").alias("most"))
    return split_join(counts, best, ["b"]).select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame) -> DataFrame:
    """The rows of ``align`` without groups and links, with n_links, n_best (links whose pair is the most linked one of
    its b, ties included) and count_sum (the counts of the pairs, summed over links).

    The links of a text are counted by pair before they are shuffled to the corpus counts, so a pair that stands in every
    text has one row a text.
    """
    rows = durable(aligned.withColumn("_row", F.monotonically_increasing_id()))
    counts = pair_counts(rows)
    each = rows.select("_row", F.inline("links"))
    joined = split_join(each, counts, ["a", "b"])
    sums = joined.groupBy("_row").agg(
        F.sum("n").alias("n_links"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")
    )
    filled = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_links", "n_best", "count_sum")]
    own = [c for c in rows.columns if c not in ("_row", "links")]
    return rows.drop("links").join(sums, "_row", "left").select(*own, *filled)
