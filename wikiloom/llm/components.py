"""Connected components of a graph that is given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.shared import stored


def _smallest(edges: DataFrame) -> DataFrame:
    """Per node the smallest of itself and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_smallest(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("v < u")
    smallest = _smallest(down)
    moved = down.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the smallest node.

    Nodes are hung below the smallest neighbour, larger and smaller ones in
    turn, until no link moves; the rounds grow with the logarithm of the
    longest path. Each round is stored, so a lost executor costs one round.
    Neighbours are combined before the shuffle; none are gathered per node.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   "links")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        edges = stored(_small_star(_large_star(edges)), "links")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(roots)
