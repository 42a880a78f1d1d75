"""Connected components of an edge table by alternating large and small stars.

Each round replaces edges by edges to the smallest neighbour, until every node points at the
smallest node it can reach. Rounds are groupings and joins over the edges, written to the shared
folder, so no task holds a component and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from winnow.llm.common import Scratch


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node of an edge that is not its component's smallest node."""
    scratch = Scratch(edges.sparkSession, "components")
    pairs = (edges.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    pairs, turn = scratch.write(pairs, "0"), 0
    while True:
        both = pairs.unionByName(pairs.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        # Large star: larger neighbours are linked to the smallest of the neighbourhood.
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        least = scratch.write(least, f"{turn}-large")
        large = (both.join(least, "hi").where("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct())
        large = scratch.write(large, f"{turn}-linked")
        # Small star: smaller neighbours and the node itself are linked to the smallest.
        least = scratch.write(large.groupBy("hi").agg(F.min("lo").alias("m")), f"{turn}-small")
        moved = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        after = scratch.write(moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct(), str(turn + 1))
        mark = [F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))]
        same = tuple(after.agg(*mark).head()) == tuple(pairs.agg(*mark).head())
        scratch.drop(str(turn), f"{turn}-large", f"{turn}-linked", f"{turn}-small")
        pairs, turn = after, turn + 1
        if same:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
