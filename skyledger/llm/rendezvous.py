"""Sharding by rendezvous hashing of stable record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.durable import durable
from skyledger.llm.stable_order import RANK_BITS, bucket_totals, rank, running


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest score for a key, each shard in proportion to its weight.

    A shard's score is -weight / ln(u) with u a uniform hash of key and shard, so it depends on no other shard: a new
    shard takes just those records for which it scores highest, and a shard that goes gives up only its own. A null key
    is an empty key. Equal scores go to the lower shard.
    """
    scored = []
    for shard, weight in enumerate(weights):
        u = (rank(f"shard {shard}", key) + 0.5) / float(1 << RANK_BITS)
        # the least -ln(u) / weight is the highest score
        scored.append(F.struct((-F.log(u) / weight).alias("cost"), F.lit(shard).alias("shard")))
    return F.least(*scored)["shard"] if len(scored) > 1 else F.lit(0)


def spread(docs: DataFrame, weights: Sequence[float] = (1.0,) * 8, grown: Sequence[float] | None = None) -> DataFrame:
    """Rows of docs with their shard, slot and grown_shard.

    The shard follows from doc_id and the weights alone. Slots number the rows of a shard without gap from 0, in a
    pseudo-random order of doc_id and then text_crc32, which docs must have; grown_shard is the shard under ``grown``, by
    default the same weights and one more shard of the last weight. Rows that share a doc_id share a shard; those equal
    in all columns may swap slots. Rows without doc_id are placed by the empty key. An empty table gives an empty result;
    columns of docs named shard, slot or grown_shard are replaced.
    """
    grown = [*weights, weights[-1]] if grown is None else grown
    rows = docs.withColumns({"shard": shard_of(F.col("doc_id"), weights), "grown_shard": shard_of(F.col("doc_id"), grown)})
    rows = rows.withColumns({"_one": F.lit(1).cast("long"), "_order": rank("slot", F.col("doc_id"), F.col("text_crc32"))})
    buckets = bucket_totals(rows, docs.count(), "shard", "_order", "_one")
    return running(rows, buckets, "shard", "_order", ["doc_id", "text_crc32"], "_one", "slot").drop("_one", "_order")


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text, 0 for a null, and one for the separator."""
    return (F.octet_length(F.coalesce(text.cast("string"), F.lit(""))) + 1).cast("long")


def sharded(docs: DataFrame, weights: Sequence[float] = (1.0,) * 8) -> DataFrame:
    """Every document (doc_id, text) with its size, text_crc32, the law of its placement, shard, slot and grown_shard.

    The law is ``key``: doc_id and the shards decide. A null text is empty. Other columns of docs are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = durable(docs.select("doc_id", text_size(text).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")))
    placed = spread(narrow, weights)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
