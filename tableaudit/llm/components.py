"""Connected components of a graph given as edges, by joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableaudit.llm.common import staged


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): the smallest node it is linked with.

    Distributed union-find by turns of large and small stars: each node hands its
    larger neighbours to the smallest one it knows, then its smaller ones.  A turn
    only groups and joins, so a hub's edges are spread, and their number does not
    grow.  It ends when a turn changes nothing.  Edges from a node to itself only
    name the node; an empty table gives an empty result.
    """
    named = staged(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    alone = named.where("hi = lo").select(F.col("hi").alias("node"))
    pairs = named.where("hi != lo")
    state = _state(pairs)
    while state[0]:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        pairs = staged(small.union(least.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        before, state = state, _state(pairs)
        if state == before:
            break
    nodes = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
    return nodes.union(
        alone.join(nodes.select("node"), "node", "left_anti").select("node", F.col("node").alias("root"))
    )


def _state(pairs: DataFrame) -> tuple:
    """Number of edges and a sum over them that changes when any of them does."""
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
