"""Connected components by alternating large-star and small-star steps.

Each step replaces edges by edges to the smallest neighbour, so a component collapses into a star
in about log(diameter) rounds.  A node's smallest neighbour is a partial aggregate; a hub's edges
look it up in a broadcast of bounded size (``lookup``), so they are never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlink.functions.runtime import checkpoint, lookup


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = _both(edges)
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"), F.count("*").alias("_n"))
    joined = lookup(both, least, "src", 2 * rows).filter("dst > src")
    # one edge for each given one at most: repeats may stay until the small star
    return joined.select(F.col("dst").alias("src"), F.col("low").alias("dst")).filter("src <> dst")


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("low"), F.count("*").alias("_n"))
    moved = lookup(down, least, "src", rows).select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(least.select("src", F.col("low").alias("dst"))).filter("src <> dst").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): every node of an edge with the smallest node that it can reach.

    Edges are undirected; loops and repeats are allowed; edges with a null end are ignored.
    """
    # the edges may be dear to make: they are made once, also for the loops
    given = checkpoint(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).dropna().distinct())
    loops = given.filter("src = dst").select(F.col("src").alias("node"), F.col("src").alias("component"))
    now = given.filter("src <> dst")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        now = checkpoint(_small_star(_large_star(now, state[0]), state[0]))
    members = now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component"))
    return members.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))
