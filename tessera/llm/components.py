"""Connected components of an edge table by alternating star contraction, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.rows import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """A node's larger neighbours move to the smallest of its neighbours and itself."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. Edges are (u, v), u > v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every u has one edge and is nobody's v."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionAll(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    seen = ends.groupBy("x").agg(F.sum("out").alias("n_out"), F.max("into").alias("into"))
    return seen.where("n_out > 1 OR (n_out = 1 AND into = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long); component is its smallest node.

    Large and small stars alternate until every node hangs on its component's smallest one;
    each round cuts lineage with a written table. A node with many neighbours is reduced by a
    partial aggregate, and no node's neighbours are ever gathered. Self-loops and repeated
    edges are allowed; no edges give no rows.
    """
    now = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star")
    while not _is_forest_of_stars(now):
        now = stage(_small_star(stage(_large_star(now), "star-large")), "star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
