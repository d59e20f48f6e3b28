"""The pipeline against a brute-force version of every stage but the trained one, whose decisions are taken over."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as cp
from skyledger.llm import labelled, toxicity
from test_decontamination import plain as contaminated
from test_lsh_forest import plain as grouped
from test_rendezvous import plain as placed
from test_source_mixing import filled

FOLDER = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark, table):
    docs = table("documents")
    out = labelled.remainder(F.col("doc_id"), 4) == 2
    kept = toxicity.toxicity(docs, table("labels"), out).filter("not rejected").select(*docs.columns).collect()
    assert 0.7 * docs.count() < len(kept) < docs.count()
    groups = grouped([(r["doc_id"], r["text"]) for r in kept], 85, 3)
    kept = [r for r in kept if groups[r["doc_id"]][1] == r["doc_id"]]
    items = [tuple(r) for r in table("benchmark").select("item_id", "text").collect()]
    dirty = {r[0] for r in contaminated([(r["doc_id"], r["text"]) for r in kept], items) if r[5]}
    assert dirty
    kept = {r["doc_id"]: r for r in kept if r["doc_id"] not in dirty}
    words = lambda t: len((t or "").split())
    sizes = Counter()
    for r in kept.values():
        sizes[r["source"]] += words(r["text"])
    want = filled(dict(sizes), (3, 1, 2), 1.5 * sum(sizes.values()), 2)

    got = cp.run(spark, FOLDER).collect()
    taken, whole = Counter(), Counter()
    for r in got:
        source = kept[r["doc_id"]]
        taken[r["source"]] += words(r["text"])
        if r["text"] == source["text"]:
            whole[r["doc_id"]] += 1
            assert (r["source"], r["lang"], r["n_chars"]) == (source["source"], source["lang"], source["n_chars"])
        else:
            assert source["text"].split()[: words(r["text"])] == r["text"].split()
            assert r["n_chars"] == len(r["text"])
        assert r["shard"] == placed(r["doc_id"], [1.0] * 8) and r["grown_shard"] == placed(r["doc_id"], [1.0] * 9)
        assert r["size"] == len(r["text"].encode()) + 1
    assert {s: n for s, n in taken.items()} == {s: int(t + 1e-9) for s, t in want.items() if int(t + 1e-9)}
    assert max(whole.values()) <= 2
    assert sum(r["text"] != kept[r["doc_id"]]["text"] for r in got) <= len(sizes)
    for shard, n in Counter(r["shard"] for r in got).items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))


def test_stages_keep_the_columns_of_documents(spark, awkward):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert {"shard", "slot"} <= set(cp.STAGES[-1][1](spark, docs, FOLDER).columns)


def test_stages_take_an_empty_table(spark, table):
    docs = table("documents").limit(0)
    for name, stage in cp.STAGES:
        assert stage(spark, docs, FOLDER).collect() == [], name
