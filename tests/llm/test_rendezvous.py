import hashlib
import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from skyledger.llm import rendezvous as rv


def plain(key, weights):
    cost = []
    for shard, weight in enumerate(weights):
        u = (int(hashlib.md5(f"shard {shard}|{'' if key is None else key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        cost.append((-math.log(u) / weight, shard))
    return min(cost)[1]


def test_documents_equal_plain_python(table):
    texts = table("documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in rv.sharded(table("documents")).collect()}
    assert len(got) == len(texts)
    for doc_id, text in texts:
        data = (text or "").encode()
        r = got[doc_id]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")
        assert (r["shard"], r["grown_shard"]) == (plain(doc_id, [1.0] * 8), plain(doc_id, [1.0] * 9))
    for shard, n in Counter(r["shard"] for r in got.values()).items():
        assert sorted(r["slot"] for r in got.values() if r["shard"] == shard) == list(range(n))


def test_a_new_shard_takes_rows_only_into_itself_and_in_proportion(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    placed = keys.select(rv.shard_of(F.col("doc_id"), [1.0, 2.0, 1.0]).alias("a"), rv.shard_of(F.col("doc_id"), [1.0, 2.0, 1.0, 4.0]).alias("b"))
    moved = {(r["a"], r["b"]): r["count"] for r in placed.groupBy("a", "b").count().collect()}
    assert all(a == b or b == 3 for a, b in moved)
    assert abs(sum(n for (a, b), n in moved.items() if b == 3) - 10_000) < 400
    assert abs(sum(n for (a, b), n in moved.items() if a == 1) - 10_000) < 400


def test_awkward_rows(awkward):
    got = rv.sharded(awkward).collect()
    assert len(got) == awkward.count()
    for shard, n in Counter(r["shard"] for r in got).items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert {r["size"] for r in got if r["doc_id"] in (2, 3)} == {1}
    kept = rv.spread(awkward.withColumn("text_crc32", F.lit(1)))
    assert {"score", "kept", "node"} <= set(kept.columns) and kept.count() == awkward.count()
    assert rv.sharded(awkward.limit(0)).collect() == []
