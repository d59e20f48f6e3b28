import hashlib
import random
import re

from pyspark.sql import functions as F

from skyledger.llm import decontamination as dc

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plain(docs, items, width=13):
    out = []
    windows = {}
    for item_id, text in items:
        w = cut(text)
        for i in range(max(len(w) - width + 1, min(len(w), 1))):
            windows.setdefault(tuple(w[i : i + width]), set()).add(item_id)
    for doc_id, text in docs:
        w, hit, found = cut(text), set(), set()
        for window, ids in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= ids
        found = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), len(found), found, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()), key=str)


def test_made_documents_equal_plain_search(frame):
    dice = random.Random(4)
    words = ["the", "of", "Éa", "éa", "x1", "AND", "and", "İs", "zoo", "q"] + [f"w{i}" for i in range(40)]
    items = [(i, " ".join(dice.choices(words, k=n))) for i, n in enumerate([1, 3, 12, 13, 14, 30, 30])] + [(7, None), (8, " .. "), (9, "the"), (None, "only here once")]
    items.append((10, items[4][1].upper().replace("ÉA", "Éa").replace("İS", "İs")))
    docs = []
    for i in range(40):
        own = dice.choices(words, k=dice.choice([0, 5, 60, 400]))
        for _, text in dice.sample(items, 2):
            at, took = dice.randrange(len(own) + 1), (text or "").split()
            own[at:at] = took[: dice.choice([12, 13, 100])]
        docs.append((i // 2, dice.choice([" ", ", ", "\n"]).join(own)))
    docs += [(None, None), (None, items[5][1]), (99, ""), (99, ""), (98, docs[3][1]), (98, docs[3][1])]
    got = dc.contamination(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"))
    assert shown(got) == plain(docs, items)


def test_generated_documents_equal_plain_search(table):
    docs = [tuple(r) for r in table("documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table("benchmark").select("item_id", "text").collect()]
    assert shown(dc.contamination(table("documents"), table("benchmark"))) == plain(docs, items)


def test_many_terms_are_shuffled_in_one_pass_over_the_texts(table, monkeypatch):
    whole = shown(dc.contamination(table("documents"), table("benchmark")))
    near = sorted(map(repr, dc.proximity_matches(table("documents"), table("benchmark")).collect()))
    monkeypatch.setattr(dc, "SENT_TERMS", 50)
    assert shown(dc.contamination(table("documents"), table("benchmark"))) == whole
    assert near and sorted(map(repr, dc.proximity_matches(table("documents"), table("benchmark")).collect())) == near
    anchors = table("benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("term")).distinct().withColumn("places", F.array(F.struct(F.lit(1).alias("item"))))
    plan = dc.postings(table("documents"), anchors, 12)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet.*documents\.parquet", plan)) == 1


def test_words_close_together_match_in_any_order(frame):
    items = frame([(1, "alpha beta gamma delta epsilon"), (2, "never seen words")], "item_id long, text string")
    docs = frame([(1, "x epsilon delta, y gamma beta z alpha"), (2, "alpha " + "far " * 30 + "beta gamma delta epsilon"), (3, None)], "doc_id long, text string")
    got = dc.proximity_matches(docs, items, slop=8, share=1.0).collect()
    assert [(r["doc_id"], r["ids"], r["n_near"]) for r in got] == [(1, ["1"], 5)]


def near_by_hand(docs, items, slop, share):
    """For every document and item the places of item words with enough of its words within reach."""
    import math

    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    out = {}
    for item_id, item in items:
        own = word.findall(item.lower())
        reach, need = max(slop, len(own)), math.ceil(share * len(set(own)) - 1e-9)
        for doc_id, text in docs:
            w = word.findall((text or "").lower())
            best = max((len(set(own) & set(w[max(i - reach, 0) : i + reach + 1])) for i in range(len(w)) if w[i] in own), default=0)
            if best >= need:
                out[doc_id, str(item_id)] = best
    return out


def test_long_items_match_whatever_word_is_missing(frame):
    dice = random.Random(8)
    common = [f"c{i}" for i in range(80)]
    items = [(i, " ".join(dice.choices(common, k=n - 5) + [f"r{i}x{k}" for k in range(5)])) for i, n in enumerate((30, 40, 60, 45, 7))]
    docs = []
    for _, item in items:
        w = item.split()
        lacking = [x for x in w if not x.endswith(("x0", "x1"))]
        for own in (w, lacking, w[: len(w) // 2], dice.sample(w, len(w)), w[:10] + ["far"] * 70 + w[10:]):
            docs.append((len(docs), " ".join(["before"] * 6 + own + ["after"] * 6)))
    docs += [(len(docs) + i, " ".join(dice.choices(common, k=150))) for i in range(10)] + [(900, None), (901, "")]
    want = near_by_hand(docs, items, 20, 0.8)
    assert all((5 * i, str(i)) in want and (5 * i + 1, str(i)) in want for i in range(4))
    got = dc.proximity_matches(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()
    best = {}
    for r in got:
        best[r["doc_id"], r["ids"][0]] = max(best.get((r["doc_id"], r["ids"][0]), 0), r["n_near"])
    # every passage with the share is found; the count is that around one of the rarest words
    assert set(best) == set(want)
    assert all(best[k] <= want[k] for k in best)


def test_awkward_rows(awkward, table):
    got = dc.contamination(awkward, table("benchmark"))
    assert got.count() == awkward.count()
    assert {(r["n_words"], r["n_hit"]) for r in got.collect() if r["doc_id"] in (2, 3, 4)} == {(0, 0)}
    kept = dc.without_contaminated(awkward, table("benchmark"))
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert dc.contamination(awkward.limit(0), table("benchmark")).collect() == []
    assert {r["n_hit"] for r in dc.contamination(awkward, table("benchmark").limit(0)).collect()} == {0}


def test_digest_of_no_items_is_that_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
