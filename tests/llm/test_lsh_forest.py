import random
import re

import pytest
from pyspark.sql import functions as F

from skyledger.llm import lsh_forest
from skyledger.llm.components import connected_components
from skyledger.llm.durable import LEAST_TASKS, TASK_ROWS, counted, durable
from skyledger.llm.lsh_forest import near_duplicates, without_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, per_cent, width):
    """Components over all pairs."""
    sets = {}
    for doc_id, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
        sets[doc_id] = {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= per_cent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def plain_by_bits(rows, per_cent, width):
    """Components over all pairs, with sets as bits of whole numbers."""
    places, bits = {}, {}
    for doc_id, text in rows:
        w = text.split()
        bits[doc_id] = sum(1 << places.setdefault(s, len(places)) for s in {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))})
    size = {i: b.bit_count() for i, b in bits.items()}
    parent = {i: i for i in bits}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(bits)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = (bits[a] & bits[b]).bit_count()
            if 100 * shared >= per_cent * (size[a] + size[b] - shared):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (size[i], root(i)) for i in ids}


def crowd(seed):
    """Families of texts: copies, light and heavy edits, chains of edits, and a passage that all families share."""
    dice = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    passage = dice.choices(words, k=60)
    rows = []
    for size in (1, 1, 2, 3, 40):
        base = dice.choices(words, k=150)
        for n in range(size):
            own = list(base)
            for _ in range(dice.choice([0, 1, 2, 4, 8])):
                own[dice.randrange(len(own))] = dice.choice(words)
            if size == 3:
                base = own  # a chain: each is an edit of the one before
            rows.append(" ".join(own + (passage if size != 2 else [])))
    dice.shuffle(rows)
    return [(i + 10, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("per_cent, width", [(85, 3), (80, 5)])
def test_groups_equal_all_pairs(frame, per_cent, width):
    rows = crowd(per_cent)
    got = near_duplicates(frame(rows, "doc_id long, text string"), per_cent / 100, width).collect()
    want = plain(rows, per_cent, width)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_generated_documents_equal_all_pairs(table):
    rows = [tuple(r) for r in table("documents").select("doc_id", "text").collect()]
    got = near_duplicates(table("documents"), 0.85, 3).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain(rows, 85, 3)


def loose_family(size, seed, length=300, swaps=7):
    """Edits of one text that are mostly below the similarity of a link to each other, and some above."""
    dice = random.Random(seed)
    base = [f"w{i}" for i in range(length)]
    rows = []
    for i in range(size):
        own = list(base)
        for at in dice.sample(range(length // 3), dice.randint(swaps - 2, swaps)):
            own[at] = f"x{dice.randrange(3)}of{at}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("block", [16, 128])
def test_a_crowd_of_loose_copies_equals_all_pairs(frame, monkeypatch, block):
    monkeypatch.setattr(lsh_forest, "BLOCK", block)
    rows = loose_family(700, 3, swaps=9) + [(5000 + i, t) for i, t in enumerate(["same text in a crowd " * 9] * 40)]
    rows += [(6000 + i, rows[0][1].replace("w250", f"y{i}")) for i in range(150)]
    got = near_duplicates(frame(rows, "doc_id long, text string"), 0.85, 3).collect()
    want = plain_by_bits(rows, 85, 3)
    assert 50 < sum(root != i for i, (_, root) in want.items()) < 700
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_crowded_regions_are_parted_in_one_step(frame, monkeypatch):
    steps = []
    monkeypatch.setattr(lsh_forest, "durable", lambda df: steps.append(df) or durable(df))
    rows = loose_family(300, 3, swaps=9)
    got = near_duplicates(frame(rows, "doc_id long, text string"), 0.85, 3).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_by_bits(rows, 85, 3)
    # classes, regions, signatures and sets, candidates and links of two passes, two layouts of crowded regions, crowds
    assert 10 < len(steps) <= 16


def test_awkward_rows(awkward):
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in near_duplicates(awkward, 0.85, 3).collect()}
    assert got[2, 0] == (2, True) and got[3, 0] == (3, True) and got[4, 0] == (4, True)
    assert got[1, 8] == (1, True) and got[7, 8] == (1, False)
    assert {v for k, v in got.items() if k[0] is None} == {(None, True)}
    assert near_duplicates(awkward, 0.85, 3).count() == awkward.count()
    assert near_duplicates(awkward.limit(0)).collect() == []


def test_one_of_each_group_stays_with_its_columns(awkward):
    kept = without_duplicates(awkward, 0.85, 3)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 2, 3, 4, 5, 6, None, None]


def test_rows_stay_or_go_by_their_own_text(frame):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(60)) for k in "abcd")
    near = a.replace("a59", "x")
    rows = [
        (1, a, "s"),
        (7, near, "s"),  # goes, but not the other texts of its doc_id
        (7, b, "s"), (7, c, "s"), (7, c, "r"), (7, None, "s"), (7, None, "s"),
        (None, d, "s"), (None, d, "q"), (None, d.upper(), "s"), (None, b, "s"), (None, None, "s"), (None, None, "s"),
    ]
    for order in (rows, rows[::-1]):
        got = [tuple(r) for r in without_duplicates(frame(order, "doc_id long, text string, source string"), 0.85, 3).collect()]
        (free,) = [r for r in got if r[0] is None and r[1]]
        assert free in [(None, d, "q"), (None, d.upper(), "s")]
        got.remove(free)
        assert sorted(got, key=str) == sorted([(1, a, "s"), (7, b, "s"), (7, c, "r"), (7, None, "s"), (None, None, "s"), (None, None, "s")], key=str)


def test_a_doc_id_of_a_third_of_all_rows_loses_no_text(frame):
    dice = random.Random(5)
    rows = [(9 if i % 3 else i, " ".join(dice.choices("abcdefghijklmnopqrstuvwxyz", k=60))) for i in range(90)]
    got = without_duplicates(frame(rows, "doc_id long, text string"), 0.85, 3).collect()
    assert sorted(map(tuple, got)) == sorted(rows)


def test_components_of_paths_stars_and_loops(spark):
    dice = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 300)] + [(400, 400), (500, 501), (501, 500), (None, 3)]
    dice.shuffle(edges)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 300)} | {500: 500, 501: 500}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_components_are_found_once_from_repeated_links(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (2, 3), (1, 3)] * 3, "u long, v long")
    assert sorted(map(tuple, connected_components(edges).collect())) == [(1, 1), (2, 1), (3, 1)]


def test_no_bloom_filter_is_planned(frame, spark, tmp_path):
    made = frame([(i, f"w{i // 2} a b c d e f g h") for i in range(40)] + [(None, "x y z"), (99, " ")], "doc_id long, text string")
    made.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    # as on large tables
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = near_duplicates(docs, 0.85, 3)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "bloom" not in plan and "might_contain" not in plan
    assert found.count() == 42


def test_few_stored_rows_are_read_by_few_tasks(spark):
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 9 * TASK_ROWS, numPartitions=60)
        stored, found = counted(rows, F.max("id").alias("most"))
        none, empty = counted(rows.filter("id < 0"))
        nodes = connected_components(spark.createDataFrame([(i, i // 2) for i in range(1, 40)], "u long, v long"))
        tasks = [df.rdd.getNumPartitions() for df in (stored, none, nodes)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert (found, empty) == ({"rows": 9 * TASK_ROWS, "most": 9 * TASK_ROWS - 1}, {"rows": 0})
    assert stored.distinct().count() == 9 * TASK_ROWS and none.collect() == []
    assert tasks[0] == 9 and tasks[1] <= LEAST_TASKS and tasks[2] <= LEAST_TASKS
    assert {tuple(r) for r in nodes.collect()} == {(i, 0) for i in range(40)}


def test_regions_are_looked_at_again_only_if_some_are_crowded(frame, monkeypatch):
    looked, regions = [], lsh_forest._Forest._with_regions
    monkeypatch.setattr(lsh_forest._Forest, "_with_regions", staticmethod(lambda rows: looked.append(rows) or regions(rows)))
    rows = crowd(1)[:9]
    got = near_duplicates(frame(rows, "doc_id long, text string"), 0.85, 3).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain(rows, 85, 3)
    assert len(looked) == 1
