"""Connected components by joins: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.workspace import Workspace


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (node, root): the smallest node that each node can reach. Nodes without an edge are left out.

    Each step hangs every node's neighbours on its smallest neighbour: first the larger ones, then the
    smaller ones. A node's smallest neighbour is an aggregate, so a node with very many neighbours is never gathered. The
    rounds grow with the logarithm of the longest chain; each is stored, which cuts the lineage.
    """
    def pairs(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = ws.store(pairs(edges), "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            break
        seen = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = pairs(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = ws.store(large, "large-star")
        ws.drop(now)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.inline(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
        now = ws.store(pairs(small), "small-star")
        ws.drop(large)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
