"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is a stream: its documents in a stable pseudo-random order, over again if its target asks for more than it
holds. The stream up to the target is cut into blocks of words, and the number of a source's blocks is its quota. A
binary tree parts the quotas among the output shards: at each node the left half of the shards draws its blocks without
replacement from all blocks of the node, so its counts by source follow the multivariate hypergeometric law and the right
half gets what remains. The counts of the leaves add up to the quotas exactly. The blocks of a stream are permuted, and each
shard draws as many of them, in that order, as the tree gave it, disjoint from every other shard's; it reads its documents
in a pseudo-random order of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.durable import durable
from skyledger.llm.stable_order import Buckets, bucket_totals, rank, running

WORD = r"[^\x20\x09-\x0D]+"
#: Blocks of the whole mix, about; it sets how finely sources are interleaved, not what is taken.
BLOCKS = 20_000
#: Blocks are permuted by this factor, a prime above the number of blocks of any source.
PERMUTE = 15_485_863
#: Counts further than this many standard deviations from their mean have no weight that a double could show.
DEVIATIONS = 10


def word_count(text: Column) -> Column:
    """Stretches without white space; none in a null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """Words to take from each source, from a table (source, source_size) with a row for each source.

    Sources in order of code points, null last, get the weights in turn, and by them share ``share`` times all words. A
    source gives at most ``most`` times its size; what is above goes to the others by weight. The table has one row a
    source, so its windows run over a few rows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everyone = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    out = sizes.withColumns({"weight": weight, "cap": F.col("source_size") * F.lit(float(most))})
    out = out.withColumn("ratio", F.col("cap") / F.col("weight"))
    up_to = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    # if the sources of lowest ratio are full, this is what a unit of weight gets of the rest; the true level is the highest
    full = F.coalesce(F.sum("cap").over(up_to.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(up_to.rowsBetween(0, Window.unboundedFollowing))
    out = out.withColumn("level", (F.sum("source_size").over(everyone) * F.lit(float(share)) - full) / open_weight)
    return out.withColumn("target", F.least("cap", F.max("level").over(everyone) * F.col("weight"))).select("source", "source_size", "target")


def _drawn(total: Column, marked: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` blocks drawn without replacement from ``total`` are among the ``marked``.

    The hypergeometric law inverted at u: weights of consecutive counts follow from one another, so their sum and then
    the count at which the sum passes u are two folds over the counts near the mean.
    """
    total, marked, draws = (c.cast("double") for c in (total, marked, draws))
    mean = draws * marked / F.greatest(total, F.lit(1.0))
    spread = F.sqrt(mean * (1 - marked / F.greatest(total, F.lit(1.0))) * (total - draws) / F.greatest(total - 1, F.lit(1.0)))
    low = F.greatest(F.lit(0.0), draws - (total - marked), F.floor(mean - DEVIATIONS * (spread + 1)))
    high = F.least(marked, draws, F.ceil(mean + DEVIATIONS * (spread + 1)))
    counts = F.sequence(low.cast("long"), F.greatest(high, low).cast("long"))

    def following(w: Column, k: Column) -> Column:
        return w * (marked - k) * (draws - k) / ((k + 1) * (total - marked - draws + k + 1))

    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
    whole = F.aggregate(counts, start, lambda s, k: F.struct(following(s["w"], k).alias("w"), (s["sum"] + s["w"]).alias("sum")), lambda s: s["sum"])
    start = F.struct(F.lit(1.0).alias("w"), (u * whole).alias("left"), low.cast("long").alias("at"))

    def step(s: Column, k: Column) -> Column:
        here = s["left"] >= 0
        return F.struct(following(s["w"], k).alias("w"), F.when(here, s["left"] - s["w"]).otherwise(s["left"]).alias("left"), F.when(here, k).otherwise(s["at"]).alias("at"))

    return F.aggregate(counts, start, step, lambda s: s["at"])


def splitting_tree(quotas: DataFrame, shards: int, seed: str = "mix") -> DataFrame:
    """For each source and shard the blocks it gets, from a table (source, quota).

    Returns source and ends, an array with the last block (exclusive) of each shard in the source's stream. A node of the
    tree is one row with a count for each source, so sources are meant to be few; ``shards`` is a power of two.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("the number of shards must be a power of two")
    entry = F.struct(F.col("source").alias("source"), F.col("quota").alias("n"))
    nodes = quotas.agg(F.array_sort(F.collect_list(entry)).alias("counts")).select(F.lit(0).alias("node"), "counts")
    for _ in range(shards.bit_length() - 1):
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c["n"])
        start = F.struct(
            F.col("total").alias("rest"), F.ceil(F.col("total") / 2).cast("long").alias("draws"),
            F.expr("cast(array() as array<struct<source: string, n: bigint, l: bigint>>)").alias("out"),
        )

        def part(s: Column, c: Column) -> Column:
            u = (F.pmod(F.xxhash64(F.lit(seed), F.col("node"), c["source"]), F.lit(1 << 52)) + 0.5) / float(1 << 52)
            got = _drawn(s["rest"], c["n"], s["draws"], u)
            row = F.array(F.struct(c["source"].alias("source"), c["n"].alias("n"), got.alias("l")))
            return F.struct((s["rest"] - c["n"]).alias("rest"), (s["draws"] - got).alias("draws"), F.concat(s["out"], row).alias("out"))

        parted = nodes.withColumn("total", total).select("node", F.aggregate("counts", start, part, lambda s: s["out"]).alias("counts"))
        parted = durable(parted)
        left = F.transform("counts", lambda c: F.struct(c["source"].alias("source"), c["l"].alias("n")))
        right = F.transform("counts", lambda c: F.struct(c["source"].alias("source"), (c["n"] - c["l"]).alias("n")))
        halves = F.array(F.struct((2 * F.col("node") + 0).alias("node"), left.alias("counts")), F.struct((2 * F.col("node") + 1).alias("node"), right.alias("counts")))
        nodes = parted.select(F.inline(halves))
    leaves = nodes.select(F.col("node").alias("shard"), F.inline("counts"))
    gathered = leaves.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("by_shard"))
    upto = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda j: F.aggregate(F.slice("by_shard", 1, j), F.lit(0).cast("long"), lambda s, c: s + c["n"]))
    return gathered.select("source", upto.alias("ends"))


def text_key(text: Column) -> Column:
    """Tells texts apart in the order of a stream."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")))


def plan(
    docs: DataFrame, size: str = "size", weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, shards: int = 8, ties: Sequence[str] = ()
) -> DataFrame:
    """Every row of docs with what the mix takes of it.

    docs has doc_id, source and a column of words (``size``). All its columns are kept, and these are added or replaced:
    source_size, target (words to take from the source) and takes, an array with an entry for each time the document is
    taken, ``most`` times at most: repeat (0 at the first time), words (all of the document, fewer at the end of the
    target), block (of the source's stream, in which it begins), shard, and shuffle, by which the rows of a shard are to be
    sorted.

    A null source is a source, the last; a null size counts as 0, and a document of size 0 is not taken. The order of a
    stream follows from doc_id, the columns named as ``ties`` and size, so reruns agree; rows equal in all of them may
    change places, and are ordered by one task. Name a column that tells texts apart (``text_key``) where ids can repeat
    or be null: such rows then lie apart. An empty table gives an empty result.
    """
    docs = docs.withColumns({"_source": F.col("source").cast("string"), "_size": F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long"))})
    docs = docs.withColumn("_order", rank("mix", F.col("doc_id"), *[F.col(t) for t in ties]))
    buckets = bucket_totals(docs, docs.count(), "_source", "_order", "_size")
    totals = durable(buckets.totals)
    sizes = totals.groupBy(F.col("_source").alias("source")).agg(F.sum("held").alias("source_size"))
    aims = targets(sizes, weights, share, most).withColumn("quota", F.floor("target").cast("long"))
    everything = Window.partitionBy()
    aims = aims.withColumn("block", F.greatest(F.lit(1).cast("long"), F.ceil(F.sum("quota").over(everything) / BLOCKS).cast("long")))
    aims = durable(aims.withColumn("blocks", F.ceil(F.col("quota") / F.col("block")).cast("long")))
    tree = splitting_tree(aims.select("source", F.col("blocks").alias("quota")), shards)
    aims = aims.join(tree.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    aims = aims.select(F.col("source").alias("_of"), F.struct("source_size", "target", "quota", "block", "blocks", "ends").alias("_aim"))
    aimed = totals.join(aims, totals["_source"].eqNullSafe(aims["_of"])).drop("_of")
    placed = running(docs, Buckets(buckets.bits, aimed), "_source", "_order", ["doc_id", *ties, "_size"], "_size", "_from")

    def take(repeat: Column) -> Column:
        begin = F.col("_from") + repeat * F.col("_aim.source_size")
        block = F.floor(begin / F.col("_aim.block")).cast("long")
        drawn = F.pmod(block * PERMUTE + F.pmod(F.xxhash64("_source"), F.lit(PERMUTE)), F.greatest(F.col("_aim.blocks"), F.lit(1).cast("long")))
        shard = F.size(F.filter("_aim.ends", lambda e: e <= drawn))
        words = F.least(F.col("_size"), F.col("_aim.quota") - begin)
        return F.struct(repeat.alias("repeat"), words.alias("words"), block.alias("block"), shard.alias("shard"), F.xxhash64(shard, repeat, "_order").alias("shuffle"))

    takes = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), take), lambda t: t["words"] > 0)
    out = placed.withColumns({"source_size": F.col("_aim.source_size"), "target": F.col("_aim.target"), "takes": takes})
    return out.drop("_source", "_size", "_order", "_from", "_aim")


def words_taken(takes: Column) -> Column:
    """All words that a document gives to the mix, repeats counted."""
    return F.aggregate(takes, F.lit(0).cast("long"), lambda s, t: s + t["words"])


def mixed(docs: DataFrame, text: str = "text", **aims) -> DataFrame:
    """The texts of the mix: a row of docs for each time it is taken, with shard and shuffle.

    The columns of docs are kept. The last document of a source's stream is cut after the words that its target leaves;
    its words are then joined by single spaces. ``aims`` are those of ``plan``.
    """
    planned = plan(docs.withColumns({"_words": word_count(F.col(text)), "_text": text_key(F.col(text))}), "_words", ties=["_text"], **aims)
    each = planned.withColumn("_take", F.explode("takes")).withColumns({"shard": F.col("_take.shard"), "shuffle": F.col("_take.shuffle")})
    cut = F.array_join(F.slice(F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != ""), 1, F.col("_take.words").cast("int")), " ")
    each = each.withColumn(text, F.when(F.col("_take.words") < F.col("_words"), cut).otherwise(F.col(text)))
    return each.drop("_take", "_words", "_text", "takes", "source_size", "target")
