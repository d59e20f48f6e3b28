"""Registered queries of this subpackage and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    alignment, decontamination, html_extraction, labelled, license_digests, lsh_forest, merge_replay, oracles, pii_spans, quality_ftrl, ranked_search,
    rendezvous, repetition, source_mixing, toxicity,
)
from skyledger.llm.durable import durable
from skyledger.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _op9(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents, linked at a similarity of 0.85 of three-word shingles."""
    ship(spark)
    return lsh_forest.near_duplicates(_table(spark, folder, "documents"), similarity=0.85, width=3)


def _op1(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of all pages."""
    ship(spark)
    return html_extraction.extract(_table(spark, folder, "pages"))


def _mix(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    docs = _table(spark, folder, "documents").select("doc_id", "source", source_mixing.word_count(text).alias("size"), source_mixing.text_key(text).alias("key"))
    return source_mixing.plan(durable(docs), ties=["key"])


def _mix_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every time the mix takes a document, with the block it begins in and the shard that drew this block."""
    return _mix(spark, folder).select("doc_id", "source", F.inline("takes"))


def _proximity(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold most words of a benchmark item close together."""
    found = decontamination.proximity_matches(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.groupBy("doc_id", "h", F.array_join("ids", ",").alias("items")).agg(F.max("n_near").alias("n_near"), F.count("*").alias("n_places")).drop("h")


def _op2(spark: SparkSession, folder: str) -> DataFrame:
    """How often and how far the mix of all documents takes each of them."""
    planned = _mix(spark, folder)
    return planned.select("doc_id", "size", "source_size", "target", source_mixing.words_taken(F.col("takes")).alias("taken"))


def _op3(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in all documents."""
    ship(spark)
    return pii_spans.personal_data(_table(spark, folder, "documents"), with_text=False).drop("redacted")


def _op4(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside the held-out quarter."""
    ship(spark)
    held_out = labelled.remainder(F.col("doc_id"), 4) == 2
    scored = toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"), held_out)
    return scored.select("doc_id", "held_out", "score", "predicted", "rejected")


def _op5(spark: SparkSession, folder: str) -> DataFrame:
    """Licenses of all documents and of their lines."""
    return license_digests.scan(_table(spark, folder, "documents"), license_digests.registry(spark))


def _op6(spark: SparkSession, folder: str) -> DataFrame:
    """Repetition rules on all documents."""
    ship(spark)
    return repetition.judge(_table(spark, folder, "documents"))


def _op7(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents, learned from labels outside the held-out third."""
    ship(spark)
    held_out = labelled.remainder(F.col("doc_id"), 3) == 1
    scored = quality_ftrl.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"), held_out)
    return scored.select("doc_id", "held_out", "score", "predicted")


def _op8(spark: SparkSession, folder: str) -> DataFrame:
    """Shards, slots and grown shards of all documents."""
    return rendezvous.sharded(_table(spark, folder, "documents"))


def _op10(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents inside 13-word windows of the benchmark."""
    found = decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def _op11(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    ship(spark)
    return ranked_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), 10)


def _op12(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded again."""
    ship(spark)
    return merge_replay.digests(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _op13(spark: SparkSession, folder: str) -> DataFrame:
    """The tokens of all documents in two vocabularies, aligned."""
    ship(spark)
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    aligned = alignment.align(_table(spark, folder, "documents"), *paths)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    return alignment.link_scores(aligned.select("doc_id", "n_a", "n_b", "n_groups", digest, "links"))


def queries() -> dict[str, Query]:
    return {
        "op1_tag_path_ratios": _op1,
        "op2_source_mixing": _op2,
        "op3_pii_spans": _op3,
        "op4_toxicity": _op4,
        "op5_license_digests": _op5,
        "op6_repetition": _op6,
        "op7_quality_ftrl": _op7,
        "op8_rendezvous": _op8,
        "op9_lsh_forest": _op9,
        "op10_decontamination": _op10,
        "op11_geometric_blocks": _op11,
        "op12_merge_replay": _op12,
        "op13_token_alignment": _op13,
        "mix_shards": _mix_shards,
        "benchmark_proximity": _proximity,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_source_mixing": oracles.OP2,
        "op5_license_digests": oracles.op5(license_digests.known_texts(), license_digests.SPELLINGS),
        "op6_repetition": oracles.op6(repetition.NGRAM_SHARES, repetition.LINE_SHARE),
        "op8_rendezvous": oracles.OP8,
        "op9_lsh_forest": oracles.OP9,
        "op10_decontamination": oracles.OP10,
        "op11_geometric_blocks": oracles.OP11,
    }
