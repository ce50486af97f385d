"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

ROUNDS = 60


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (u, v) with v < u: of each node, the neighbours
    (larger ones, or smaller ones and the node) link to the smallest."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (two long columns); the
    component is its smallest node.  Links in either direction, loops and
    repeats are fine.  Every step is a join and an aggregation over the link
    table, checkpointed in the shared folder; the number of steps grows with the
    logarithm of the longest path."""
    a, b = links.columns
    edges = checkpointed(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    seen = None
    for _ in range(ROUNDS):
        edges = checkpointed(_stars(_stars(edges, True), False))
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
