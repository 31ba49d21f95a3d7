"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a pre-aggregated minimum and a join, so a node with very many
links is a hot join key that Spark may split, never one task's group.  Steps
are written to the shared folder; only whether one remains reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import drop_kept, kept


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
    moved = edges.join(least, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node either has one edge to a smaller node or is one that edges lead to."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.sum("into").alias("into")).where("out > 1 or (out > 0 and into > 0)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b", files: int | None = None) -> DataFrame:
    """(node, label) for every node that has a link, a table in the shared folder: label is the smallest node of its component.

    Links that are null at an end or join a node to itself count for nothing.
    files: the most files that a step's table is written as.
    """
    edges = kept(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges", files)
    while not _is_stars(edges):
        after = kept(_small_star(_large_star(edges)), "edges", files)
        drop_kept(edges)
        edges = after
    labels = kept(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v").distinct()), "labels", files)
    drop_kept(edges)
    return labels
