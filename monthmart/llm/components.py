"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import materialize


def _large_stars(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours linked to the least node around it; edges (u, v) have u > v, and so have the links."""
    ends = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    # Only the less end of an edge has the other as a greater neighbour, so edges are joined by that one.
    least = ends.groupBy(F.col("u").alias("centre")).agg(F.min("v").alias("m"))
    return edges.join(least, F.col("v") == F.col("centre")).select("u", F.least("centre", "m").alias("v"))


def _small_stars(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours linked to the least of these; edges (u, v) have u > v, and so have the links."""
    least = edges.groupBy(F.col("u").alias("centre")).agg(F.min("v").alias("m"))
    linked = edges.join(least, F.col("u") == F.col("centre")).select(
        F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
    )
    return linked.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): component is the least node that links reach. links: (a, b), in any order.

    Nodes without links have no row, null ends are passed over, and no links give no rows. Both halves of a turn are written to
    the shared folder, so lost executors repeat one half at most, and the driver holds a short plan at a time; a node's
    neighbours are never brought together. The number of turns grows with the logarithm of the longest path.
    """
    edges = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    state = None
    while True:
        edges = materialize(_small_stars(materialize(_large_stars(edges), "component-stars")), "component-edges")
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
