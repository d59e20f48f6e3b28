"""Benchmark decontamination with a positional inverted index.

Test texts are few, training texts are many. The index therefore stores postings (document, position) of those training
tokens that the search starts from: the two rarest terms, counted over all training texts, of every test window. Each
posting keeps the words around it. Postings are shifted by the term's offset in the test item, so the lists of two terms
of a window meet where the window can occur; the words kept around the rarest one then decide exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.frames import may_hold, split_join
from skyledger.llm.durable import durable

#: Between words stand all ASCII characters but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: So many terms, or places of terms in test items, are sent to every executor at most; more are shuffled.
SENT_TERMS = 100_000


def words(text: Column) -> Column:
    """The words of a text in order; none of a null. Letters keep their case."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BETWEEN), lambda w: w != "")


def _lower(each: Column) -> Column:
    """Words with A-Z in lower case and nothing else changed."""
    return F.transform(each, lambda w: F.translate(w, UPPER, LOWER))


def _items(benchmark: DataFrame, width: int) -> DataFrame:
    """One row for each different word sequence: the ids of its items, its words and its windows."""
    own = _lower(words(F.col("text").cast("string")))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), own.alias("words")).filter("size(words) > 0")
    items = items.groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    return items.withColumn("item", F.xxhash64(F.array_join("words", " ")))


def _places(terms: DataFrame) -> int:
    """Terms, or the places that they are looked for at."""
    return terms.agg(F.sum(F.size("places") if "places" in terms.columns else F.lit(1))).first()[0] or 0


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id, a hash that tells apart rows of one doc_id, and the words of the text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").alias("doc_id"), F.xxhash64(text).alias("h"), words(text).alias("words"))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each term (a lower-case word) occurs in the training texts; terms that do not occur have no row."""
    each = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), BETWEEN)).alias("term"))
    if _places(terms) <= SENT_TERMS:
        found = each.join(F.broadcast(terms), "term")
    else:
        found = split_join(each.filter(may_hold(terms, "term")(F.col("term"))), terms, ["term"])
    return found.groupBy("term").agg(F.count("*").alias("n"))


def _anchors(items: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """Windows (start, length) of items with the offsets of their rarest term (r1) and the next rarest (r2).

    A window with a term that no training text has cannot occur and is left out. In a window of one word r2 is r1.
    """
    size = F.size("words")
    starts = F.explode(F.sequence(F.lit(0), F.greatest(size - width, F.lit(0)))).alias("start")
    windows = items.select("item", "words", starts, F.least(size, F.lit(width)).alias("length"))
    offsets = windows.select("item", "start", "length", F.posexplode(F.slice("words", F.col("start") + 1, F.col("length"))).alias("k", "word"))
    offsets = offsets.select("item", "start", "length", (F.col("start") + F.col("k")).alias("offset"), F.lower("word").alias("term"))
    ranked = offsets.join(counts, "term").groupBy("item", "start", "length").agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("by_n"))
    ranked = ranked.filter(F.size("by_n") == F.col("length"))
    first, second = F.col("by_n")[0], F.coalesce(F.get("by_n", F.lit(1)), F.col("by_n")[0])
    return ranked.select("item", "start", "length", first.alias("one"), second.alias("two"))


def postings(docs: DataFrame, anchors: DataFrame, around: int) -> DataFrame:
    """The index: a row for each place where an anchor term stands in a training text.

    anchors has a term and the places (item, offset) it is looked for at. A row has the document (doc_id, h), the
    position of the term, up to ``around`` words on either side of it (context, from position ``begin``) and the places.
    Up to SENT_TERMS places are sent to every executor. Of more, the words of the training texts are held against a table of
    bits of the terms, and those that pass are shuffled to them with their context; either way the texts are read once.
    """
    each = _documents(docs).select("doc_id", "h", "words", F.posexplode("words").alias("position", "word"))
    each = each.withColumn("term", F.lower("word"))
    begin = F.greatest(F.col("position") - around, F.lit(0))
    context = _lower(F.slice("words", begin + 1, F.col("position") - begin + 1 + around))
    posting = ["doc_id", "h", "position", begin.alias("begin"), context.alias("context")]
    if _places(anchors) <= SENT_TERMS:
        return each.join(F.broadcast(anchors), "term").select(*posting, "places")
    passed = each.filter(may_hold(anchors, "term")(F.col("term"))).select(*posting, "term")
    return split_join(passed, anchors, ["term"]).drop("term")


def phrase_matches(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """Exact occurrences of benchmark windows in documents.

    A window is ``width`` consecutive words of an item's text, or all words of a shorter one; words are stretches of
    digits, letters and characters beyond ASCII, compared with A-Z in lower case. Returns a row for each document (doc_id
    and h, the hash of its text), item and start of an alignment: ids (the items of these words), and matches, the
    windows that occur, as structs of the document position and the length.

    Null and empty texts have no words and no match. Items of equal words are one; repeated rows of a document are one.
    """
    items = durable(_items(benchmark, width))
    terms = items.select(F.explode("words").alias("word")).select(F.lower("word").alias("term")).distinct()
    windows = durable(_anchors(items, durable(term_counts(docs, terms)), width))
    marked = F.array(F.struct("one", F.lit(True).alias("rarest")), F.struct(F.col("two").alias("one"), F.lit(False).alias("rarest")))
    ends = windows.select("item", "length", F.inline(marked)).select("item", "length", "rarest", "one.offset", "one.term")
    # only the rarest term of a window needs the words around it; in a window of one word it meets nothing else
    ends = ends.groupBy("item", "offset", "term").agg(F.max("rarest").alias("rarest"), (F.min("length") == 1).alias("alone"))
    places = F.collect_set(F.struct("item", "offset", "rarest", "alone"))
    anchors = durable(ends.groupBy("term").agg(places.alias("places")))
    found = postings(docs, anchors, width - 1)
    # shifted by the offset in the item, the postings of one occurrence agree in where the item would begin
    shifted = found.select("doc_id", "h", "position", "begin", "context", F.explode("places").alias("p"))
    near = F.when(F.col("p.rarest"), F.struct("begin", "context")).alias("near")
    shifted = shifted.select("doc_id", "h", "p.item", "p.offset", "p.alone", (F.col("position") - F.col("p.offset")).alias("shift"), near)
    meeting = shifted.groupBy("doc_id", "h", "item", "shift").agg(
        F.map_from_entries(F.collect_set(F.struct("offset", "near"))).alias("at"), F.max("alone").alias("alone")
    )
    meeting = meeting.filter("alone or cardinality(at) > 1").drop("alone")
    sought = windows.groupBy("item").agg(F.collect_list(F.struct("start", "length", F.col("one.offset").alias("r1"), F.col("two.offset").alias("r2"))).alias("windows"))
    sought = sought.join(items, "item").select("item", "ids", "words", "windows")

    def occurs(w: Column) -> Column:
        near = F.col("at")[w["r1"]]
        both = F.map_contains_key("at", w["r1"]) & F.map_contains_key("at", w["r2"])
        first = F.col("shift") + w["start"] - near["begin"]
        same = F.slice(near["context"], F.greatest(first, F.lit(0)) + 1, w["length"]) == F.slice("words", w["start"] + 1, w["length"])
        return both & F.when(both, (first >= 0) & same).otherwise(False)

    place = lambda w: F.struct((F.col("shift") + w["start"]).alias("start"), w["length"].alias("length"))
    met = split_join(meeting, sought, ["item"]).select("doc_id", "h", "item", "ids", "shift", F.transform(F.filter("windows", occurs), place).alias("matches"))
    return met.filter("size(matches) > 0")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int = 20, share: float = 0.8) -> DataFrame:
    """Documents that hold most words of an item close together, in any order.

    A row for each document (doc_id, h), item (ids) and position at which one of the item's rarest words stands with at
    least ``share`` of the item's different words within reach, itself included; n_near counts them. The reach on either
    side is ``slop`` words, or the length of the item if it is longer, so a copy is found whatever its length. A passage
    with the share of an item must hold one of its rarest words, if so many are taken that the others are too few for the
    share; all of them are looked up. Null and empty texts match nothing.
    """
    items = durable(_items(benchmark, 1).withColumn("different", F.array_distinct("words")))
    need = F.ceil(F.lit(share) * F.size("different") - 1e-9).cast("int")
    items = durable(items.withColumns({"need": F.greatest(need, F.lit(1)), "reach": F.greatest(F.size("words"), F.lit(slop))}))
    each = items.select("item", "need", "reach", F.size("different").alias("n_words"), F.explode("different").alias("word"))
    each = each.withColumn("term", F.lower("word"))
    counts = durable(term_counts(docs, each.select("term").distinct()))
    rarity = Window.partitionBy("item").orderBy(F.coalesce("n", F.lit(0)), "word")
    rarest = each.join(counts, "term", "left").withColumn("r", F.row_number().over(rarity)).filter("r <= n_words - need + 1 and n is not null")
    anchors = rarest.groupBy("term").agg(F.collect_set(F.struct("item", "reach", "need", "word")).alias("places"))
    widest = items.agg(F.max("reach")).first()[0] or 0
    found = postings(docs, durable(anchors), widest).select("doc_id", "h", "position", "begin", "context", F.explode("places").alias("p"))
    first = F.greatest(F.col("position") - F.col("p.reach"), F.lit(0)) - F.col("begin")
    own = F.slice("context", first + 1, F.col("position") - F.col("begin") - first + 1 + F.col("p.reach"))
    near = found.select("doc_id", "h", "position", own.alias("near"), F.col("p.item").alias("item"), F.get("context", F.col("position") - F.col("begin")).alias("at"), F.col("p.word").alias("word"))
    near = split_join(near.filter("at = word"), items.select("item", "ids", "different", "need"), ["item"])
    near = near.withColumn("n_near", F.size(F.array_intersect("near", "different"))).filter("n_near >= need")
    return near.select("doc_id", "h", "item", "ids", "position", "n_near").distinct()


def _covered(spans: Column) -> Column:
    """The number of positions in the union of spans (start, length) sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(done: Column, s: Column) -> Column:
        end = F.greatest(done["end"], (s["start"] + s["length"]).cast("long"))
        return F.struct((done["n"] + end - F.greatest(done["end"], s["start"].cast("long"))).alias("n"), end.alias("end"))

    return F.aggregate(spans, zero, add, lambda done: done["n"])


def _hits(docs: DataFrame, benchmark: DataFrame, width: int) -> DataFrame:
    """Documents with matches: hit_id and hit_h, the words inside matches, and the items."""
    matches = phrase_matches(docs, benchmark, width).select("doc_id", "h", "ids", "matches")
    spans = F.array_sort(F.array_distinct(F.flatten(F.collect_list("matches"))))
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids"))))
    return matches.groupBy("doc_id", "h").agg(_covered(spans).alias("n_hit"), items.alias("items")).withColumnsRenamed({"doc_id": "hit_id", "h": "hit_h"})


def _contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """For every row of docs its words, the words inside benchmark windows, and the items that these belong to.

    docs has doc_id and text, benchmark item_id and text; other columns are not read. Returns doc_id, n_words, n_hit
    (words inside any occurrence), n_items, items (sorted as strings) and contaminated: at least one word is hit, and at
    least one in twenty. A document without words has zeros and is clean; an item without an id has occurrences but no
    name, so it is hit and not listed. Rows may repeat or lack a doc_id: each is judged by its own text.
    """
    text = F.col("text").cast("string")
    sizes = docs.select("doc_id", F.xxhash64(text).alias("h"), F.size(words(text)).cast("long").alias("n_words"))
    hits = _hits(docs, benchmark, width)
    out = sizes.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("h") == F.col("hit_h")), "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    out = out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"))
    return out.withColumn("contaminated", _contaminated(F.col("n_hit"), F.col("n_words")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """The rows of docs, with their columns as they are, that are not contaminated."""
    hits = _hits(docs, benchmark, width)
    text = F.col("text").cast("string")
    same = docs["doc_id"].eqNullSafe(hits["hit_id"]) & (F.xxhash64(text) == F.col("hit_h"))
    return docs.join(hits, same & _contaminated(F.col("n_hit"), F.size(words(text))), "left_anti")
