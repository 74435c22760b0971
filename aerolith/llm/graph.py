"""Connected components of a link table by min-label contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm import common as C


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; the component is the
    smallest node that can be reached.

    Alternates the two star steps of the large-star/small-star method; both are
    a grouped minimum (combined before the shuffle, so a node with very many
    links costs no single task more) and a join back. The minima are written
    first: a join of two plain shuffles is one whose hot keys AQE can split. Each
    round's links are written to the shared folder as well, so a lost executor costs one
    round at most.
    """
    edges = C.stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u <> v").distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while True:
        # Large star: each node points its larger neighbours to the smallest.
        both = edges.union(edges.select("v", "u"))
        low = C.stored(both.groupBy("u").agg(F.min("v").alias("m"))
                       .select("u", F.least("u", "m").alias("m")), "minima")
        large = both.join(low, "u").filter("v > u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: each node's smaller neighbours point to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u") \
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                    .alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        after = C.stored(small, "edges")
        # It is done when no node has two parents and no parent has a parent.
        twice = after.groupBy("u").count().filter("count > 1").limit(1)
        chain = after.join(after.select(F.col("u").alias("v")), "v", "left_semi").limit(1)
        edges = after
        if twice.isEmpty() and chain.isEmpty():
            break
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
