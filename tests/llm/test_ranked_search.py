import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    """Every document scored for every item."""
    bags = [(doc_id, Counter(TERM.findall((text or "").translate(FOLD)))) for doc_id, text in docs]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    total = sum(sum(bag.values()) for _, bag in bags)
    having = Counter(t for _, bag in bags for t in bag)
    weight = lambda t: math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * having[t] + 1)))
    out = []
    for item_id, text in items:
        terms = Counter(TERM.findall((text or "").translate(FOLD)))
        found = []
        for doc_id, bag in bags:
            m = 100 - 75 + (75 * sum(bag.values()) * len(bags)) // total
            score = sum(c * weight(t) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t, c in terms.items() if t in bag)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, doc_id, -score) for r, (score, _, _, doc_id) in enumerate(sorted(found)[:k], 1)]
    return sorted(map(repr, out))


def result(df):
    return sorted(repr(tuple(r)) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def test_whole_tables(table):
    docs, items = table("documents"), table("benchmark")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert result(rs.search(docs, items)) == want


@pytest.mark.parametrize("terms_a_pass", [rs.TERMS_A_PASS, 3])
def test_awkward_rows(spark, awkward, monkeypatch, terms_a_pass):
    monkeypatch.setattr(rs, "TERMS_A_PASS", terms_a_pass)
    items = [(1, "Some WORDS words"), (2, None), (3, ""), (None, "text, id"), (3, "x 1"), (5, "nowhere"), (6, "of some length and of")]
    asked = spark.createDataFrame([(*r, 7) for r in items], "item_id long, text string, score int")
    docs = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    found = rs.search(awkward, asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert result(found) == brute(docs, items)


def test_empty_tables(spark, awkward):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rs.search(awkward, none).count() == 0
    some = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert rs.search(awkward.limit(0), some).count() == 0
    assert rs.search(awkward.filter("text is null"), some).count() == 0


def test_scores_of_the_first_shards_are_a_lower_bound_only(table, monkeypatch):
    monkeypatch.setattr(rs, "FIRST_DOCS", 50)
    docs, items = table("documents").repartition(8), table("benchmark")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert result(rs.search(docs, items)) == want


@pytest.mark.parametrize("block_docs", [4, 64])
def test_blocks_are_skipped_and_lose_nothing(monkeypatch, block_docs):
    monkeypatch.setattr(rs, "BLOCK_DOCS", block_docs)
    dice = np.random.default_rng(3)
    # documents of a few topics, so that blocks of a list differ
    topic = dice.integers(0, 12, 1500)
    impacts = np.where(dice.random((1500, 60)) < np.where(np.arange(60)[None] // 5 == topic[:, None], 0.6, 0.03), dice.integers(1, 10**6, (1500, 60)), 0).astype(np.int32)
    weights = dice.integers(0, 9000, 60)
    terms = [np.sort(dice.choice(60, n, replace=False)) for n in dice.integers(1, 9, 40)]
    terms += [np.arange(5 * t, 5 * t + 5) for t in range(12)]
    queries = rs.Queries([b""] * 60, terms, [dice.integers(1, 3, len(t)) for t in terms], weights)
    together = queries.together()
    shard = rs.Shard.build(impacts, weights, together)
    for t in range(60):
        own = shard.members[shard.blocks[shard.lists[t]] : shard.blocks[shard.lists[t + 1]]]
        assert sorted(own) == np.flatnonzero(impacts[:, t]).tolist()
    scored = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple) and len(key) == 2 and isinstance(key[0], np.ndarray):
                scored.append(len(key[0]))
            return super().__getitem__(key)

    shard.impacts = impacts.view(Counting)
    found = {q: list(zip(docs.tolist(), np.asarray(scores).tolist())) for q, docs, scores in shard.search(queries, together, np.zeros(len(terms), np.int64), 10)}
    listed = 0
    for q, (own, counts) in enumerate(zip(terms, queries.counts)):
        scores = impacts[:, own].astype(np.int64) @ (counts * weights[own])
        best = np.lexsort((np.arange(1500), -scores))[:10]
        assert found.get(q, []) == [(int(d), int(scores[d])) for d in best if scores[d] > 0]
        listed += (impacts[:, own] > 0).any(axis=1).sum()
    if block_docs == 4:
        assert sum(scored) < 0.8 * listed


def test_the_registered_query_is_whole(spark, table):
    from skyledger.llm import entries

    found = entries.queries()["op11_geometric_blocks"](spark, "/root/testdata/sf0.001")
    counts = found.groupBy("item_id").agg(F.count("*").alias("n"), F.countDistinct("rank").alias("ranks")).collect()
    assert len(counts) == table("benchmark").count() and all(r["n"] == r["ranks"] == 10 for r in counts)
