"""Connected components of an edge table, by alternating large and small stars.

Each step sends the neighbours of a node to its smallest neighbour; minima are
aggregated before they are shuffled and joined back on the node, so a hub's
edges can be split over tasks.  Every step is written to the shared folder;
nothing but two sums for each step reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, keep


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges are (a, b) with a > b.  Large star: the larger neighbours of a node go to its minimum;
    small star: the node and its smaller neighbours do."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: its smallest node."""
    edges = keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seal = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = seal(edges)
    while before[0]:
        last, edges = edges, keep(_star(_star(edges, True), False), "edges")
        discard(last)
        now = seal(edges)
        if now == before:
            break
        before = now
    # all edges now point at their component's smallest node
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
