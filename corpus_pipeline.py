"""From raw documents to sharded training text, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import decontamination, labelled, lsh_forest, rendezvous, source_mixing, toxicity
from skyledger.llm.durable import durable
from skyledger.llm.shipping import ship


#: Tasks that lay out the rows of one shard of the mix, at most.
SHARD_PARTS = 4096


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that the toxicity classifier rejects, learned from labels outside the held-out quarter."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels, labelled.remainder(F.col("doc_id"), 4) == 2)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id."""
    ship(spark)
    return lsh_forest.without_duplicates(docs, similarity=0.85, width=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of which a twentieth and more stands in the benchmark."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document; the last one that a source gives is cut to its target.

    Rows are laid out by the shard that drew them, in the order of its shuffle, each shard over as many tasks as it needs.
    """
    mixed = source_mixing.mixed(docs)
    mixed = mixed.repartition("shard", F.pmod("shuffle", F.lit(SHARD_PARTS))).sortWithinPartitions("shard", "shuffle")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        mixed = mixed.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(kind)))
    return mixed.select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard, its slot there and the shard it has if there is one more."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.withColumns({"size": rendezvous.text_size(text), "text_crc32": F.crc32(text.cast("binary")), "law": F.lit("key")})
    return rendezvous.spread(sized)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", shard),
]

#: A trained classifier decides in the first stage, which SQL cannot express; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage keeps is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
