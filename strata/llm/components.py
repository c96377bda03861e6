"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.scratch import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; a component's name is its smallest node.

    Each round links the neighbours of a node to their smallest one, first those above the node, then
    those below it. Both steps are a minimum per node, which is combined before the shuffle, and
    a join that may be split where one node has many links. Rounds end when nothing changes; their number grows
    with the logarithm of the longest path. Every round is stored, so lost executors cost one round.
    Links from a node to itself and null ends are ignored; without links the result is empty.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("w")), F.struct(F.col("v").alias("u"), F.col("m").alias("w")))).alias("e"))
        after = stored(small.select("e.u", F.col("e.w").alias("v")).where("u <> v").distinct(), "stars")
        if _state(edges) == _state(after):
            break
        edges = after
    roots = after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return after.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
