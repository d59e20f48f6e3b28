"""Registered queries against their check statements on the smallest tables."""

import pytest

import corpus_pipeline
from compare import connect, duck_rows, spark_rows
from skyledger.llm import entries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    1: "page_id url text n_chars",
    2: "doc_id size source_size target taken",
    3: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    4: "doc_id held_out score predicted",
    5: "doc_id",
    6: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    7: "doc_id held_out score predicted",
    8: "doc_id size text_crc32 law shard slot grown_shard",
    9: "doc_id n_shingles component_id kept",
    10: "doc_id n_words n_hit n_items items_sha256 contaminated",
    12: "doc_id n_tokens ids_sha256 decoded_sha256",
    13: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
}
#: Further queries that show what the operators return beside their contracts.
MORE = {"mix_shards", "benchmark_proximity"}


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_equals_check_statement(spark, name):
    got = spark_rows(entries.queries()[name](spark, FOLDER))
    assert got == duck_rows(connect(FOLDER), entries.oracle_sql()[name])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in set(entries.queries()) - MORE) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(entries.queries()) - set(entries.oracle_sql()) - MORE))
def test_query_has_a_row_for_each_of_its_table(spark, name):
    number = int(name[2:].split("_")[0])
    rows = entries.queries()[name](spark, FOLDER)
    assert set(COLUMNS[number].split()) <= set(rows.columns)
    assert rows.count() == spark.read.parquet(f"{FOLDER}/{'pages' if number == 1 else 'documents'}.parquet").count()


def test_further_queries(spark):
    takes = entries.queries()["mix_shards"](spark, FOLDER)
    words = entries.queries()["op2_source_mixing"](spark, FOLDER).agg({"taken": "sum"}).first()[0]
    assert takes.agg({"words": "sum"}).first()[0] == words
    near = entries.queries()["benchmark_proximity"](spark, FOLDER)
    assert near.columns == ["doc_id", "items", "n_near", "n_places"]
    hit = entries.queries()["op10_decontamination"](spark, FOLDER).filter("n_hit > 0").select("doc_id")
    assert near.join(hit, "doc_id").count() > 0


def test_stages_are_in_order():
    assert [name.split("_")[0] for name, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "benchmark", "source", "sharding"]
