"""Connected components of an edge table that may not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the component is its smallest node.

    Large and small stars by turns: a node first links its larger neighbours, then its smaller ones and itself, to the
    smallest node it knows. Edges never become more and nothing is cut off, and distances halve, so a path of 5,000 nodes
    settles in about a dozen rounds; rounds end when the edges stay as they are, however many that takes. The smallest
    neighbour is a partial minimum joined back, so a hub's neighbours meet as one row a task. No edges give no rows; loops and
    repeated edges are harmless.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars, before = staged(ends.where("u > v").distinct(), "stars"), None
    while before != (before := _state(stars)):
        both = stars.union(stars.select("v", "u"))
        large = _least_known(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
        known = _least_known(large.distinct())
        # The node itself goes with its smallest neighbour; any other neighbour goes there too.
        moved = F.explode(F.array("u", "v")).alias("u")
        stars = staged(known.select(moved, F.col("least").alias("v")).where("u > v").distinct(), "stars")
    root = stars.select(F.col("u").alias("_u"), F.col("v").alias("component"))
    return nodes.join(root, nodes["node"] == root["_u"], "left").select("node", F.coalesce("component", "node").alias("component"))


def _least_known(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with the smallest neighbour of u."""
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("least"))
    return edges.join(least, F.col("u") == F.col("_u")).drop("_u")


def _state(edges: DataFrame) -> tuple:
    """Two numbers that change with the edges."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum")).first()
    return row["n"], row["sum"]
