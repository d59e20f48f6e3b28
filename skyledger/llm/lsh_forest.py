"""Near-duplicate documents by an LSH forest.

Every document is reduced to its distinct word shingles and these to a MinHash signature of ``DIGITS`` values. A tree of
the forest is the order of all documents by their signature read from another digit on, so ``TREES`` trees share one
signature. Documents with a long common prefix in a tree stand together there and are candidates.

A first pass compares every document with the first one of its regions, which joins most of a crowd of copies. A second
one looks only at regions that still hold several groups, and there only at pairs of different groups. How deep their
prefix has to be is settled region by region: a small region is compared in full, a crowded one with its first document,
and is then parted by longer prefixes until it is small. What is still crowded by several groups after that is finished
exactly: its documents are dealt to blocks by group and size, and every two blocks that can hold a link are multiplied as
matrices of shingles. Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.frames import split_join
from skyledger.llm import text_arrays as ta
from skyledger.llm.components import connected_components
from skyledger.llm.durable import counted, durable, release

DIGITS = 64
TREES = 16
#: A region begins at this many common digits. Two documents of similarity s share a region of a given tree with
#: probability s^FIRST_DEPTH; at 0.8 all sixteen trees miss a pair once in 5,000 times, at 0.85 once in 130,000 times.
FIRST_DEPTH = 4
#: Depths by which crowded regions are parted further.
DEEPER = (5, 6, 8, 10, 12, 16, 24, 32, 64)
#: Regions of at most this many documents are compared in full, so a document meets its nearest neighbours of each tree.
FULL_REGION = 24
#: Pairs whose signatures agree in fewer digits than this share of the required similarity are not compared: more than
#: five standard deviations of the estimate below what a true link shows.
ESTIMATE_SHARE = 0.7
#: Documents that a block of a crowd is meant to hold, and shingles of one step of the product of two blocks.
BLOCK, STEP = 128, 8192


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For every run of texts its first row and the sorted distinct shingles of each text."""
    for run in ta.runs(batch.column("text"), ta.SMALL_RUN_BYTES):
        w = ta.words(run, ~ta.WHITE, ta.FOLD)
        hashes, begins = ta.shingles(w.hashes, w.at, width)
        yield run.first, [np.unique(hashes[begins[i] : begins[i + 1]]) for i in range(run.count)]


def _signatures(sets: list[np.ndarray], multipliers: np.ndarray) -> np.ndarray:
    """One row of DIGITS values of 32 bits for each set; zeros for an empty set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((len(sets), len(multipliers)), np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        values = np.concatenate([sets[i] for i in full])
        begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        scratch = np.empty_like(values)
        for k, m in enumerate(multipliers):
            np.multiply(values, m, out=scratch)
            out[full, k] = (np.minimum.reduceat(scratch, begins) >> np.uint64(32)).astype(np.uint32)
    return out


def _sketcher(width: int, kept: str | None = None):
    """Maps (doc_id, text) to the size and digest of each text's set with its signature.

    With the name of an id kept, maps (id, text, _low, _high) to these without the text, the digest and the set itself.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = ta.seeds(DIGITS, 23)
        for batch in batches:
            for first, sets in _sets(batch, width):
                low = np.array([s.sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
                high = np.array([ta.mix(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
                digest = {"low": pa.array(low.view(np.int64)), "high": pa.array(high.view(np.int64))}
                of = lambda name: batch.column(name).slice(first, len(sets))  # noqa: E731, B023
                if kept:
                    shingles = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                    columns = {kept: of(kept), **digest, "_low": of("_low"), "_high": of("_high"), "shingles": shingles}
                else:
                    signature = pa.array([r.tobytes() for r in _signatures(sets, multipliers)], pa.binary())
                    columns = {"doc_id": of("doc_id"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()), **digest, "signature": signature}
                yield pa.RecordBatch.from_pydict(columns)

    return sketch


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The share of equal digits of two signatures."""
    for batch in batches:
        left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, DIGITS) for c in ("sig_a", "sig_b"))
        share = (left == right).mean(axis=1) if len(left) else np.zeros(0)
        keep = [batch.column(c) for c in ("a", "b", "need")]
        out = pa.RecordBatch.from_arrays([*keep, pa.array(share)], names=["a", "b", "need", "share"])
        yield out


def _overlaps(left: pa.StructArray, right: pa.StructArray) -> np.ndarray:
    """The sizes of the intersections of all sets of one block with all of another."""
    sides = []
    for block in (left, right):
        sets = block.flatten()[block.type.get_field_index("shingles")]
        sides.append((np.repeat(np.arange(len(sets)), sets.value_lengths().to_numpy()), sets.flatten().to_numpy()))
    shared = np.intersect1d(sides[0][1], sides[1][1])
    total = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, len(shared), STEP):
        some = shared[first : first + STEP]
        parts = []
        for (row, shingle), block in zip(sides, (left, right)):
            at = np.minimum(np.searchsorted(some, shingle), len(some) - 1)
            held = some[at] == shingle
            matrix = np.zeros((len(block), len(some)), np.float32)
            matrix[row[held], at[held]] = 1
            parts.append(matrix)
        total += parts[0] @ parts[1].T
    return total.astype(np.int64)


def _multiplier(per_cent: int):
    """Maps pairs of blocks to the links (u < v) between documents of different groups."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                left, right = (batch.column(c)[r].values for c in ("left", "right"))
                (node_a, group_a, n_a), (node_b, group_b, n_b) = (
                    [dict(zip((f.name for f in b.type), b.flatten()))[c].to_numpy() for c in ("node", "group", "n")] for b in (left, right)
                )
                need = -(-per_cent * (n_a[:, None] + n_b[None, :]) // (100 + per_cent))
                found = (_overlaps(left, right) >= need) & (group_a[:, None] != group_b[None, :])
                i, j = np.nonzero(found)
                u, v = np.minimum(node_a[i], node_b[j]), np.maximum(node_a[i], node_b[j])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return links


def _prefix(depth: int) -> Column:
    """A key of the first digits of the signature as the tree ``t`` orders them."""
    at = F.col("t") * (4 * DIGITS // TREES)
    turned = F.concat(F.col("signature").substr(at + 1, F.lit(4 * DIGITS)), F.col("signature").substr(F.lit(1), at))
    return F.xxhash64("t", turned.substr(1, 4 * depth))


def sketches(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, the size of each text's shingle set, a digest (low, high) of the set and its signature."""
    schema = "doc_id long, n_shingles long, low long, high long, signature binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_sketcher(width), schema)


def _stored(df: DataFrame, *more: Column) -> tuple[DataFrame, dict]:
    """Narrow rows stored by ``durable``, with their number."""
    return counted(df, *more, store=durable)


class _Forest:
    """The regions of representatives, and what the passes have found so far."""

    def __init__(self, docs: DataFrame, reps: DataFrame, similarity: float, width: int):
        self.per_cent = round(100 * similarity)
        trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t")
        rows = reps.select("node", trees, "signature").select("node", "t", _prefix(FIRST_DEPTH).alias("key"))
        shared = rows.groupBy("t", "key").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
        #: Rows of regions with more than one document, with the first of the region.
        self.rows, _ = _stored(split_join(rows, shared.drop("last"), ["t", "key"]))
        #: Rows of the crowded regions that held several groups when candidates were taken, if there are any.
        self.front: DataFrame | None = None
        members = self.rows.select("node").distinct()
        #: Signatures and full sets of these documents. No document has many rows, so these joins need no splitting.
        self.signatures, _ = _stored(reps.join(members, "node", "left_semi").dropDuplicates(["node"]))
        own = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
        digests = self.signatures.select("node", F.col("low").alias("_low"), F.col("high").alias("_high"))
        texts = own.join(digests, "node").dropDuplicates()
        sets = texts.mapInArrow(_sketcher(width, "node"), "node long, low long, high long, _low long, _high long, shingles array<long>")
        # of texts that share an id those of the document itself
        self.sets = durable(sets.filter("low = _low and high = _high").select("node", "shingles"))

    def first_candidates(self) -> DataFrame:
        """Every document with the first one of each of its regions."""
        return self.rows.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()

    def candidates(self, groups: DataFrame) -> DataFrame:
        """Pairs of documents of different groups that stand together in a region; some are repeated.

        A region of few documents gives all such pairs, a crowded one those with its first document. Documents of crowded
        regions are taken on to deeper prefixes, and each is compared in full in the largest of its regions there that is
        small.
        """
        named = split_join(self.rows.drop("first"), groups, ["node"], "left")
        rows = named.select("t", F.lit(FIRST_DEPTH).alias("depth"), "key", "node", F.coalesce("component", "node").alias("group"))
        shared, found = _stored(self._with_regions(rows), F.count_if(F.col("n") > FULL_REGION).alias("crowded"))
        front = shared.filter(F.col("n") > FULL_REGION)
        few, crowded = shared.filter(F.col("n") <= FULL_REGION), front
        if found["crowded"]:
            self.front = front.select("t", "depth", "key", "node")
            turned = split_join(front.select("node", "group", "t"), self.signatures.select("node", "signature"), ["node"])
            prefixes = F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("key")) for d in DEEPER])
            # stored, since its regions are counted and joined back to it
            parted, _ = _stored(turned.select("t", "node", "group", F.inline(prefixes)))
            deep, _ = _stored(self._with_regions(parted))
            small = deep.filter(F.col("n") <= FULL_REGION)
            least = small.withColumn("small", F.min("depth").over(Window.partitionBy("node", "t"))).filter("depth = small").drop("small")
            few, crowded = few.unionByName(least), crowded.unionByName(deep.filter(F.col("n") > FULL_REGION))
        # a small region is held by one row; each of its documents meets those of other groups above it
        regions = few.groupBy("t", "depth", "key").agg(F.collect_list(F.struct("node", "group")).alias("held"))
        meets = lambda x: F.transform(F.filter("held", lambda y: (x["node"] < y["node"]) & (x["group"] != y["group"])), lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))
        full = regions.select(F.inline(F.flatten(F.transform("held", meets))))
        first = crowded.filter("group <> first_group and node <> first")
        return full.unionByName(first.select(F.col("first").alias("a"), F.col("node").alias("b")))

    def crowd_links(self, groups: DataFrame) -> DataFrame | None:
        """All links between different groups of a crowd, some repeated; None if there is no crowd.

        Crowds are what crowded regions of several groups join together. A group of at least BLOCK documents of about one
        size gets blocks of its own, which are not held against each other, and the rest shares blocks. Sizes are cut into
        steps by the similarity, so that links lie within a step or between neighbouring ones.
        """
        if self.front is None:
            return None
        # groups have only been joined since, so regions of several groups are among those that were before
        named = split_join(self.front, groups, ["node"], "left").withColumn("group", F.coalesce("component", "node")).drop("component")
        crowded, found = _stored(self._with_regions(named).select("node", "group", "first"))
        if not found["rows"]:
            return None
        crowds = connected_components(crowded.select(F.col("first").alias("u"), F.col("node").alias("v")))
        step = F.floor(F.log(F.col("n").cast("double")) / (1.0001 * np.log(100 / self.per_cent))).cast("int")
        # each of the three has a document once
        members = crowds.withColumnRenamed("component", "crowd").join(crowded.groupBy("node").agg(F.min("group").alias("group")), "node")
        members = members.join(self.sets, "node").withColumn("n", F.size("shingles").cast("long")).withColumn("step", step)
        members = durable(members)
        place = ["crowd", "step", "group"]
        sizes = members.groupBy(*place).agg(F.count("*").alias("in_group")).withColumn("own", F.when(F.col("in_group") >= BLOCK, F.col("group")))
        shared = sizes.groupBy("crowd", "step", "own").agg(F.sum("in_group").alias("in_blocks")).withColumnsRenamed({"crowd": "_crowd", "step": "_step", "own": "_own"})
        same = (F.col("crowd") == F.col("_crowd")) & (F.col("step") == F.col("_step")) & F.col("own").eqNullSafe(F.col("_own"))
        dealt = sizes.join(shared, same).select(*place, "own", "in_blocks")
        part = F.pmod(F.xxhash64("node"), F.ceil(F.col("in_blocks") / BLOCK))
        entry = F.struct("node", "group", "n", "shingles")
        blocks = split_join(members, dealt, place).groupBy("crowd", "step", "own", part.alias("part")).agg(F.collect_list(entry).alias("held"))
        blocks = durable(blocks.withColumn("block", F.xxhash64("crowd", "step", "own", "part")))
        heads = blocks.select("crowd", "step", "own", "block")
        near = heads.select("crowd", F.explode(F.array(F.col("step") - 1, F.col("step"))).alias("step"), F.col("step").alias("of"), F.col("own").alias("other"), F.col("block").alias("second"))
        pairs = split_join(heads, near, ["crowd", "step"]).filter("(of > step or block <= second) and not coalesce(own = other, false)")
        contents = blocks.select("block", F.col("held").alias("left"))
        both = split_join(pairs.select("block", "second"), contents, ["block"])
        both = split_join(both, contents.select(F.col("block").alias("second"), F.col("left").alias("right")), ["second"])
        return both.select("left", "right").mapInArrow(_multiplier(self.per_cent), "u long, v long")

    @staticmethod
    def _with_regions(rows: DataFrame) -> DataFrame:
        """The rows of regions that hold several groups, with the region's first document, that one's group and the size."""
        measures = (F.min("node").alias("first"), F.min_by("group", "node").alias("first_group"), F.min("group").alias("g"), F.max("group").alias("h"), F.count("*").alias("n"))
        regions = rows.groupBy("t", "depth", "key").agg(*measures).filter("g < h").drop("g", "h")
        return split_join(rows, regions, ["t", "depth", "key"])

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a < b) whose full sets are similar enough."""
        one = self.signatures.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("sig_a"))
        two = self.signatures.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("sig_b"))
        sized = split_join(split_join(pairs, one, ["a"]), two, ["b"])
        sized = sized.filter(100 * F.least("n_a", "n_b") >= self.per_cent * F.greatest("n_a", "n_b"))
        # an intersection of at least this size makes the pair a link
        need = F.ceil(self.per_cent * (F.col("n_a") + F.col("n_b")) / (100 + self.per_cent)).cast("long").alias("need")
        likely = sized.select("a", "b", need, "sig_a", "sig_b").mapInArrow(_agreeing, "a long, b long, need long, share double")
        likely = likely.filter(F.col("share") >= ESTIMATE_SHARE * self.per_cent / 100).select("a", "b", "need")
        one = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
        two = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
        both = split_join(split_join(likely, one, ["a"]), two, ["b"])
        return both.filter(F.size(F.array_intersect("set_a", "set_b")) >= F.col("need")).select(F.col("a").alias("u"), F.col("b").alias("v"))

    def grow(self) -> DataFrame:
        """Linked documents and the least one of their group."""
        tried, _ = _stored(self.first_candidates())
        links, _ = _stored(self.confirmed(tried))
        groups = connected_components(links)
        pairs = self.candidates(groups).withColumn("again", F.lit(False)).unionByName(tried.withColumn("again", F.lit(True)))
        pairs, found = _stored(pairs.groupBy("a", "b").agg(F.bool_or("again").alias("again")).filter("not again").drop("again"))
        if found["rows"]:
            more, found = _stored(self.confirmed(pairs))
            if found["rows"]:
                groups = connected_components(more.unionByName(self._star(groups)))
        release(groups.sparkSession)
        last = self.crowd_links(groups)
        if last is not None:
            last, found = _stored(last)
            if found["rows"]:
                groups = connected_components(last.unionByName(self._star(groups)))
        return groups

    @staticmethod
    def _star(groups: DataFrame) -> DataFrame:
        """Links that hold groups together."""
        return groups.select(F.col("node").alias("u"), F.col("component").alias("v"))


def near_duplicates(docs: DataFrame, similarity: float = 0.8, width: int = 5) -> DataFrame:
    """Document groups: one row for every row of docs with doc_id, n_shingles, component_id and kept.

    docs has doc_id (whole numbers; texts that are none stop the job) and text; other columns are not read and may have any
    name. Texts are split at white space, A-Z lower-cased; a set is the distinct shingles of ``width`` words, or the whole sequence of a shorter text. Two
    documents are linked if the intersection of their sets is at least ``similarity`` (in whole per cent) of the union;
    component_id is the smallest doc_id that a document reaches over links.

    A null or empty text, or one of white space, has no shingles and is a group of its own. Of rows that repeat a
    doc_id each gets the group of its own text. A row without doc_id takes no part in links: its component_id is null
    and it is kept. An empty table gives an empty result.
    """
    # told by a stored flag: of a filter by comparison Spark makes bloom filters for the join below, MBs that each stage carries
    sketch = durable(sketches(docs, width).withColumn("in_groups", F.expr("doc_id is not null and n_shingles > 0")))
    named = sketch.filter("in_groups")
    # equal sets are one node, whatever their number; its name is the least doc_id of them
    least = F.min_by(F.struct("n_shingles", "signature"), "doc_id").alias("of")
    classes, _ = _stored(named.groupBy("low", "high").agg(F.min("doc_id").alias("node"), least).select("node", "low", "high", "of.*"))
    groups = _Forest(docs, classes, similarity, width).grow()
    release(docs.sparkSession)  # the forest's rows and sets
    grouped = classes.select("node", "low", "high").join(groups, "node", "left").select("low", "high", F.coalesce("component", "node").alias("component_id"))
    shown = split_join(named.select("doc_id", "n_shingles", "low", "high"), grouped, ["low", "high"]).select("doc_id", "n_shingles", "component_id")
    lone = sketch.filter(~F.col("in_groups")).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return shown.unionByName(lone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_duplicates(docs: DataFrame, similarity: float = 0.8, width: int = 5) -> DataFrame:
    """The rows of docs, one of each group of near duplicates: the one with the smallest doc_id, those without one last.

    Rows are grouped by their own texts, whatever doc_id they repeat or lack. Of rows that repeat the kept doc_id and text
    the one whose other columns come first as JSON stays. Rows without words are in no group: they stay, one of each
    doc_id and text, and all of those without doc_id. All columns of docs are kept as they are. Texts are told apart by a
    64-bit hash.
    """
    text = F.col("text").cast("string")
    key = {"_none": F.col("doc_id").isNull(), "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), "_hash": F.xxhash64(text)}
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.withColumns(key)
    some = rows.filter(worded)
    texts = some.select(F.col("_hash").alias("doc_id"), text.alias("text")).dropDuplicates(["doc_id"])
    found = near_duplicates(texts, similarity, width).select(F.col("doc_id").alias("_hash"), F.col("component_id").alias("_group"))
    # the first row of each text, then of each group of texts
    firsts = some.groupBy("_hash").agg(F.min(F.struct("_none", "_id", "_hash")).alias("_first"))
    kept = split_join(firsts, found, ["_hash"]).groupBy("_group").agg(F.min("_first").alias("_first")).select("_first.*")
    left = split_join(some, kept, list(key), "left_semi").unionByName(rows.filter(~worded & ~F.col("_none")))
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    single = left.groupBy(*key).agg(F.min("text").alias("text"), F.min_by(rest, F.to_json(rest)).alias("_rest")).select("text", "_rest.*")
    return single.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.filter(~worded & F.col("doc_id").isNull()))
