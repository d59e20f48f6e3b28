from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyledger.llm import source_mixing as sm


def filled(sizes, weights, budget, most):
    """Targets by passing on the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, rest = {}, dict.fromkeys(names)
    while rest:
        left = budget - sum(full.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] > most * sizes[s]]
        if not above:
            return full | share
        for s in above:
            full[s] = most * sizes[s]
            del rest[s]
    return full


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5}, {"é": 7, "a": 7, "Z": 7, None: 900}, {"a": 0, "b": 3}, {"a": 0}, {"only": 12}])
def test_targets_equal_sharing_the_excess_again(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in sm.targets(table).collect()}
    assert got == {s: pytest.approx(t) for s, t in filled(sizes, (3, 1, 2), 1.5 * sum(sizes.values()), 2).items()}


def test_tree_parts_quotas_exactly_and_evenly(spark):
    quotas = {"a": 4000, "b": 1, "c": 0, None: 999, "d": 3000}
    table = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    ends = {r["source"]: r["ends"] for r in sm.splitting_tree(table, 8).collect()}
    counts = {s: [b - a for a, b in zip([0, *e], e)] for s, e in ends.items()}
    assert {s: sum(c) for s, c in counts.items()} == quotas
    assert {sum(c[k] for c in counts.values()) for k in range(8)} <= {999, 1000, 1001}
    assert all(min(c) >= 0 for c in counts.values())
    # 500 and 375 blocks a shard are expected; the hypergeometric law has standard deviations of 15 and 14
    assert all(400 < n < 600 for n in counts["a"]) and all(285 < n < 465 for n in counts["d"])
    assert len(set(counts["a"])) > 1
    again = {r["source"]: r["ends"] for r in sm.splitting_tree(table, 8).collect()}
    assert again == ends


def test_drawn_counts_follow_the_hypergeometric_law(spark):
    from math import comb

    grid = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"))
    got = grid.select(sm._drawn(F.lit(20), F.lit(8), F.lit(6), F.col("u")).alias("k")).groupBy("k").count().collect()
    law = {k: comb(8, k) * comb(12, 6 - k) / comb(20, 6) for k in range(7)}
    assert {r["k"]: r["count"] / 4000 for r in got} == {k: pytest.approx(p, abs=3e-4) for k, p in law.items() if p > 3e-4}


def test_sources_reach_their_targets_and_shards_hold_disjoint_takes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("size", sm.word_count(F.col("text")))
    rows = sm.plan(docs, shards=4).collect()
    assert len(rows) == docs.count()
    taken, target, shards = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert sum(t["words"] for t in r["takes"]) <= 2 * r["size"]
        for t in r["takes"]:
            shards[t["shard"]] += t["words"]
            taken[r["source"]] += t["words"]
        target[r["source"]] = r["target"]
    assert dict(taken) == {s: int(t) for s, t in target.items()}
    assert set(shards) == {0, 1, 2, 3}
    # whole documents of up to 5,000 words go to the shard of the block in which they begin
    mean = sum(shards.values()) / 4
    assert all(0.7 * mean < n < 1.3 * mean for n in shards.values())


def test_mixed_texts_have_the_words_that_are_taken(table):
    docs = table("documents")
    sizes = {r["source"]: r["n"] for r in docs.groupBy("source").agg(F.sum(sm.word_count(F.col("text"))).alias("n")).collect()}
    want = filled(sizes, (3, 1, 2), 1.5 * sum(sizes.values()), 2)
    got = sm.mixed(docs).groupBy("source").agg(F.sum(sm.word_count(F.col("text"))).alias("n")).collect()
    assert {r["source"]: r["n"] for r in got} == {s: int(t + 1e-9) for s, t in want.items()}


def test_awkward_rows(awkward):
    docs = awkward.withColumn("size", sm.word_count(F.col("text")))
    rows = sm.plan(docs).collect()
    assert len(rows) == awkward.count()
    assert all(r["takes"] == [] for r in rows if r["size"] == 0)
    assert {r["source"] for r in rows} == {"s1", "s2", "s3", "", None}
    assert {"score", "kept", "shard", "words", "h"} <= set(sm.mixed(awkward).columns)
    assert sm.plan(docs.limit(0)).collect() == []
    assert sm.mixed(awkward.limit(0)).collect() == []


def test_shards_draw_permuted_blocks_as_the_tree_parts_them(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.select("doc_id", "source", sm.word_count(F.col("text")).alias("size"), sm.text_key(F.col("text")).alias("key"))
    rows = sm.plan(docs, shards=4, ties=["key"]).select("source", F.inline("takes")).collect()
    sizes = {r["source"]: r["n"] for r in docs.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    quotas = {s: int(t + 1e-9) for s, t in filled(sizes, (3, 1, 2), 1.5 * sum(sizes.values()), 2).items()}
    block = max(-(-sum(quotas.values()) // sm.BLOCKS), 1)
    blocks = {s: -(-q // block) for s, q in quotas.items()}
    tree = sm.splitting_tree(spark.createDataFrame(list(blocks.items()), "source string, quota long"), 4)
    ends = {r["source"]: r["ends"] for r in tree.collect()}
    shift = {r["source"]: r["h"] for r in docs.select("source", F.pmod(F.xxhash64("source"), F.lit(sm.PERMUTE)).alias("h")).distinct().collect()}
    assert len({r["shard"] for r in rows}) == 4
    neighbours = 0
    for r in rows:
        drawn = (r["block"] * sm.PERMUTE + shift[r["source"]]) % blocks[r["source"]]
        assert r["shard"] == sum(e <= drawn for e in ends[r["source"]])
        after = ((r["block"] + 1) * sm.PERMUTE + shift[r["source"]]) % blocks[r["source"]]
        neighbours += r["shard"] == sum(e <= after for e in ends[r["source"]])
    assert neighbours < 0.6 * len(rows)  # a run of blocks would nearly always stay in its shard
    for s, n in blocks.items():
        places = sorted((b * sm.PERMUTE + shift[s]) % n for b in range(n))
        assert places == list(range(n))


def test_rows_of_one_doc_id_keep_their_places_in_any_order(frame):
    rows = [(1, "s", f"text number {i} of some words") for i in range(40)] + [(None, "s", f"another {i} text of it") for i in range(40)]
    schema = "doc_id long, source string, text string"
    one, two = (sorted(map(repr, sm.mixed(frame(r, schema)).collect())) for r in (rows, rows[::-1]))
    assert one == two


def test_a_doc_id_of_a_third_of_all_rows_is_spread_over_buckets(spark):
    from skyledger.llm.stable_order import BUCKET_ROWS, RANK_BITS, rank

    docs = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), sm.text_key(F.col("id")).alias("key"))
    bits = (30_000 // BUCKET_ROWS).bit_length()
    buckets = docs.groupBy(F.shiftright(rank("mix", F.col("doc_id"), F.col("key")), RANK_BITS - bits)).count().collect()
    assert max(r["count"] for r in buckets) < 2 * BUCKET_ROWS


def test_shards_that_are_no_power_of_two_are_refused(spark):
    with pytest.raises(ValueError):
        sm.splitting_tree(spark.createDataFrame([("a", 5)], "source string, quota long"), 6)
