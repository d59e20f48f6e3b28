"""Connected components of a graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.frames import split_join
from skyledger.llm.durable import counted


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the least node of its neighbourhood. Edges run from u to a smaller v."""
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.select(F.inline(ends)).groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
    return split_join(edges, least, ["v"]).select("u", F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of every node, and the node itself, to the least of them.

    A node has few smaller neighbours after a large star, whatever its links were, since each of them is the least of
    some neighbourhood. Links may repeat, but are never more than before.
    """
    linked = edges.groupBy("u").agg(F.collect_set("v").alias("vs")).select("u", "vs", F.array_min("vs").alias("m"))
    ends = F.transform(F.concat("vs", F.array("u")), lambda x: F.struct(x.alias("u"), F.col("m").alias("v")))
    return linked.select(F.inline(ends)).filter("u <> v")


def _nodes(edges: DataFrame) -> DataFrame:
    """Every node with the smaller nodes that it is linked to, and whether a larger one is linked to it."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("to")), F.struct(F.col("v").alias("node"), F.lit(None).cast("long").alias("to")))
    return edges.select(F.inline(ends)).groupBy("node").agg(F.collect_set("to").alias("to"), F.bool_or(F.isnull("to")).alias("root"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Nodes, each once, and the least node that each can reach, from edges (u, v) of longs.

    Nodes without an edge to another node are not in the result; loops and repeated edges change nothing; a null in
    either column makes a row no edge; edges are read twice. A hub of many links is split over tasks; the number of steps grows with the
    logarithm of the longest path.
    """
    known = edges.filter("u <> v")
    star = known.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    while True:
        # a star if every node is linked to one smaller node, its root, and no root to a smaller one
        nodes, found = counted(_nodes(_small_star(_large_star(star))), F.count_if(F.expr("size(to) > 1 or (root and size(to) > 0)")).alias("others"))
        if not found["others"]:
            return nodes.select("node", F.coalesce(F.get("to", F.lit(0)), "node").alias("component"))
        star = nodes.select(F.col("node").alias("u"), F.explode("to").alias("v"))
