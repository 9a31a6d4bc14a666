"""Connected components by alternating large-star and small-star steps, all as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from inkprint.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _step(pairs: DataFrame, emit_greater: bool) -> DataFrame:
    """Link each node's neighbours in ``pairs`` (a, b) to the least of node and neighbours."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    joined = pairs.join(least, F.col("a") == F.col("node"))
    if emit_greater:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.where("node <> m").select(F.col("node").alias("a"), F.col("m").alias("b"))
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a lesser node or none, and lesser nodes have none: steps would change nothing."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    found = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return found.where((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0)).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (least id reachable) of every node of ``edges`` (a, b).

    Each step's result is written to the shared folder, so lineage does not grow with the
    number of steps; steps end when the edges are stars around the least nodes.
    """
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = materialize(down.distinct(), "edges")
    while not _are_stars(now):
        now = materialize(_step(_step(_both_ways(now), True), False), "edges")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
