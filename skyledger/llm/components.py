"""Connected components of a graph whose edges are rows, by large and small stars.

Each step replaces edges by edges to the smallest neighbour, first of the larger
and then of the smaller neighbours of every node, until each component is a star
around its smallest node. The number of steps grows with the logarithm of
the graph's size; no component is gathered anywhere, and hub nodes are joined as
rows, so that Spark can split them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself. Grouped by more than the join needs, so that the join can split hubs."""
    least = edges.groupBy("u", F.pmod("u", F.lit(7))).agg(F.min("v").alias("m"))
    return least.select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that has an edge.

    ``edges`` has two columns of the same type; loops and repeated edges do no harm.
    """
    u, v = edges.columns
    edges = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        both = _both_ways(edges)
        large = both.join(_least_neighbour(both), F.col("u") == F.col("_u")).where("v > u")
        large = stored(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        # Edges now point from the larger to the smaller node.
        small = large.join(_least_neighbour(large), F.col("u") == F.col("_u"))
        small = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        edges = stored(small, "small-star")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
