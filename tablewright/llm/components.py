"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import materialize


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either the centre of its edges or has one edge to a centre."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("leaf")).union(edges.select("b", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.min("leaf").alias("centre"))
    return nodes.filter("leaf > 1 or (leaf = 1 and centre = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) for each node ``a`` but the least ``b`` of its component in the undirected
    ``edges`` (a, b): stars, which may again be given as edges.

    In turn, each node's larger neighbours, and then its smaller ones, are joined to the
    least neighbour (itself included), until only stars are left. Every pass is an
    aggregation and a join; nothing is gathered by node, so a node may have any number of
    edges. Repeated edges and loops are allowed.
    """
    now = materialize(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _are_stars(now):
        both = now.select("a", "b").union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        large = materialize(large, "edges")
        joined = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        now = materialize(small.filter("a != b").distinct(), "edges")
    return now
