"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a join with per-node minima (one row per node), so a hub's
edges spread over tasks; no neighbour list is ever gathered. Each round is
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .store import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node of its component."""
    now = materialise(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # A node with larger neighbours only is reached by them; the rest keep an edge to their minimum.
        large = large.unionByName(least.filter("m < u").select("u", F.col("m").alias("v")))
        down = materialise(large.filter("u != v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
        floor = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(floor, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        now = materialise(small.unionByName(floor.select("u", F.col("m").alias("v"))).distinct(), "components")
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (seen["n"], seen["x"]) == state:
            break
        state = (seen["n"], seen["x"])
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
