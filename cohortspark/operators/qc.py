"""Checks and repairs of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.functions import intervals as I

from .joins import carried, in_valid_region


def preceding(positions: DataFrame, width: int) -> DataFrame:
    """Positions with the one before: within the bin, else the last of earlier bins."""
    rows = positions.select("chrom", "pos", I.bin_of(F.col("pos"), width).alias("_bin"))
    here = rows.withColumn("_here", F.lag("pos").over(W.partitionBy("chrom", "_bin").orderBy("pos")))
    return here.join(carried(rows, F.col("pos"), rows), ["chrom", "_bin"], "left").select("chrom", "pos", F.coalesce("_here", "_carried").alias("before"))


def contiguity(positions: DataFrame, step: int = 1, width: int = 100_000) -> DataFrame:
    """Per chromosome: positions, first ones, and those that don't follow the last by ``step``."""
    seen = preceding(positions, width)
    return seen.groupBy("chrom").agg(F.count("*").alias("n"), F.count_if(F.col("before").isNull()).alias("init"), F.count_if(F.col("before").isNotNull() & (F.col("pos") != F.col("before") + step)).alias("issues"))


def gaps(positions: DataFrame, step: int = 1, width: int = 100_000) -> DataFrame:
    """Missing stretches between positions that follow by ``step``."""
    seen = preceding(positions, width).where(F.col("pos") > F.col("before") + step)
    return seen.select("chrom", (F.col("before") + step).alias("gap_start"), (F.col("pos") - step).alias("gap_end"))


def cleanup_report(points: DataFrame, regions: DataFrame, pos: str = "pos", group: str = "kind") -> DataFrame:
    """Dry run of ``cleanup``: rows per group and status."""
    marked = in_valid_region(points, regions, pos)
    return marked.groupBy(group, F.when(F.col("valid"), "valid").otherwise("invalid").alias("status")).agg(F.count("*").alias("n"))


def cleanup(points: DataFrame, regions: DataFrame, pos: str = "pos") -> DataFrame:
    """Rows inside valid regions, to be written in place of the table."""
    return in_valid_region(points, regions, pos).where("valid").select(*points.columns)
