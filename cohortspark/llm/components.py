"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """From links (u, v): every linked node with the smallest node it reaches (node, label).

    Both steps aggregate before the shuffle and join with one row per node, so a node
    with very many links is split by the adaptive join; rounds grow with the logarithm.
    """

    def stars(e: DataFrame) -> bool:
        """Whether every node has one link, to a node that has none."""
        ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("x"))
        return ends.groupBy("x.node").agg(F.sum("x.up").alias("ups"), F.min("x.up").alias("least")).where("ups > 1 OR (ups = 1 AND least = 0)").isEmpty()

    e = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "cc-links")
    while not stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialise(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc-small")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
