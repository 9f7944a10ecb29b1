"""Connected components of an undirected graph of links, as Spark joins.

Alternating large-star and small-star steps: every node's neighbours are
attached to the smallest id seen so far, until every edge leads from a node
straight to the smallest of its component.  Each step is an aggregation and a join
on the node, so a node with very many links is pre-aggregated; edges are written to
the shared folder between steps.  Both sides of a join are shuffled by the node
anyway, so they are merged there and nothing is broadcast by the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Edges (a, b), a > b.  Large star (``both_ways``): every larger neighbour
    of a node moves to the smallest id among the node and its neighbours.  Small
    star: the node and its smaller neighbours do."""
    links = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both_ways:
        links = links.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    moved = links.join(least.hint("merge"), "u")
    moved = moved.where("v > u") if both_ways else moved.unionByName(least.select("u", F.col("u").alias("v"), "m"))
    return moved.where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node of edges (a, b), a > b, has one smaller neighbour and no
    larger ones, or larger ones only: those are each component's smallest."""
    ends = (edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.count(F.when(F.expr("up > 1 OR (up > 0 AND down > 0)"), 1))).first()[0] == 0


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is its
    smallest node.  Links of a node with itself and null ends are ignored."""
    edges = (edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("_a"), F.col(b).alias("_b"))
             .where("a > b AND _a IS NOT NULL AND _b IS NOT NULL").select("a", "b").distinct())
    edges = stage(edges, "edges")
    while not _are_stars(edges):
        edges = stage(_star(_star(edges, True), False), "edges")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
