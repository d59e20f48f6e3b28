"""Byte-level BPE of documents and back, by replaying merges over the different words of a block of texts.

Words are encoded independently of each other, so a block needs no other: the index from token pair to places covers all
words of a block (``BLOCK_BYTES`` of text, or one longer text), each different word once, and nothing is shuffled. The
vocabulary, a file of bounded size, is read by the driver and sent to the executors once.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import text_arrays as ta
from skyledger.llm.byte_pairs import Merges, encode_run, tiktoken_classes

BLOCK_BYTES = 8 << 20
#: A vocabulary file above this size is refused, since every executor holds it.
LARGEST_VOCABULARY = 256 << 20


def read_file(path: str) -> bytes:
    """A vocabulary file, read by the driver; it is refused if it is too large to be sent to every executor."""
    if Path(path).stat().st_size > LARGEST_VOCABULARY:
        raise ValueError(f"{path} is larger than {LARGEST_VOCABULARY} bytes")
    return Path(path).read_bytes()


def _encoder(sent, schema: list[str]):
    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, classes = sent.value
        merges = Merges.from_ranks(ranks)
        for batch in batches:
            for run in ta.runs(batch.column("text"), BLOCK_BYTES):
                ids, begins = encode_run(merges, run, classes)
                lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(run.first, run.count), lists], names=schema)

    return run_all


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids, the tokens of every text by the rank file at ``path`` (base64 and rank a line).

    docs has doc_id and text; other columns are not read and may have any name. Every text is cut into words by the
    pattern of the vocabulary and encoded whole, without special tokens, as the tiktoken library does. Null and empty
    texts have no tokens. Rows may repeat or lack a doc_id; each gives one row. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast((read_file(path), tiktoken_classes()))
    own = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = own.select("doc_id", F.array().cast("array<int>").alias("ids")).schema
    return own.mapInArrow(_encoder(sent, schema.names), schema)


def _decoder(sent, names: list[str]):
    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Merges.from_ranks(sent.value).tokens
        for batch in batches:
            lists = batch.column("ids")
            counts = np.diff(np.asarray(lists.offsets)) if len(lists) else np.zeros(0, np.int64)
            first = 0
            while first < len(lists):
                # whole rows, about a million tokens at a time
                total = np.cumsum(counts[first:])
                last = first + max(int(np.searchsorted(total, 1 << 20, "right")), 1)
                own = lists.slice(first, last - first)
                parts = tokens.take(own.flatten())
                begins = np.concatenate([[0], total[: last - first]])
                ends = np.frombuffer(parts.buffers()[1], np.int32)[: len(parts) + 1]
                offsets = pa.py_buffer(np.ascontiguousarray(ends[begins]))
                text = pa.BinaryArray.from_buffers(pa.binary(), last - first, [None, offsets, parts.buffers()[2]])
                yield pa.RecordBatch.from_arrays([*(batch.column(n).slice(first, last - first) for n in names), text], names=[*names, "decoded"])
                first = last

    return run_all


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of a frame with ids, and the bytes these stand for as column ``decoded``. A null is an empty list."""
    sent = encoded.sparkSession.sparkContext.broadcast(read_file(path))
    whole = encoded.withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    schema = whole.withColumn("decoded", F.lit(b"")).schema
    return whole.mapInArrow(_decoder(sent, whole.columns), schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids as decimal numbers and of the bytes they decode to."""
    both = decode(encode(docs, path), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
