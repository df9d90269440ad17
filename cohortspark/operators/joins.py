"""Joins on intervals. Spark has no range join: both sides are dealt into bins and meet on (chrom, bin)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.functions import intervals as I


#: A table of at most this many rows may be broadcast; it is counted first.
BROADCAST_ROWS = 100_000
#: A range of more bins than this is dealt by coarse bins of as many bins.
LONG_BINS = 64


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows; beyond that Spark joins by shuffle and splits skew."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def binned_points(points: DataFrame, width: int, pos: str = "pos") -> DataFrame:
    return points.withColumn("_bin", I.bin_of(F.col(pos), width))


def dealt(ranges: DataFrame, width: int, occupied: DataFrame, span: int | None = None) -> DataFrame:
    """Ranges once per bin that they touch (``_bin``); a long one only for the bins of ``occupied`` (chrom, _bin).

    Blocks without calls can span megabases, so theirs are met by coarse bins instead of
    being written out. With ``span`` (a multiple of ``width``) a range stands once in each
    stretch of so many positions that it touches (``span``), and is dealt there only.
    """
    low, high = F.floor(F.least("start", "end") / width).cast("int"), F.floor(F.greatest("start", "end") / width).cast("int")
    if span:
        low, high = F.greatest(low, F.col("span") * (span // width)), F.least(high, (F.col("span") + 1) * (span // width) - 1)
    short = ranges.where(high - low < LONG_BINS).withColumn("_bin", F.explode(F.sequence(low, high)))
    far = ranges.where(high - low >= LONG_BINS).withColumns({"_low": low, "_high": high}).withColumn("_coarse", F.explode(F.expr(f"sequence(_low div {LONG_BINS}, _high div {LONG_BINS})")))
    bins = occupied.distinct().withColumn("_coarse", F.expr(f"_bin div {LONG_BINS}"))
    met = far.join(bins, ["chrom", "_coarse"]).where(F.col("_bin").between(F.col("_low"), F.col("_high")))
    return short.unionByName(met.select(*short.columns))


def point_in_range(points: DataFrame, ranges: DataFrame, width: int = 128, insertion_aware: bool = True, pos: str = "pos", how: str = "inner") -> DataFrame:
    """Points (chrom, pos) with the ranges (chrom, start, end) that hold them.

    A point has one bin, so each pair comes once. Insertion-aware: an insertion is met at its start only.
    """
    p = binned_points(points, width, pos)
    r = ranges.withColumn("_bin", F.explode(I.bins(F.col("start"), F.col("end"), width))).withColumnRenamed("chrom", "_chrom").withColumnRenamed("_bin", "_rbin")
    low = F.col("start") if insertion_aware else F.least("start", "end")
    met = (F.col("chrom") == F.col("_chrom")) & (F.col("_bin") == F.col("_rbin")) & (low <= F.col(pos)) & (F.col(pos) <= F.greatest("start", "end"))
    return p.join(r, met, how).drop("_bin", "_rbin", "_chrom")


def range_overlap(left: DataFrame, right: DataFrame, width: int = 128, insertion_aware: bool = False) -> DataFrame:
    """Pairs of overlapping ranges (chrom, start, end | r_start, r_end), each once: in the first bin that both touch."""
    a = left.withColumn("_bin", F.explode(I.bins(F.col("start"), F.col("end"), width)))
    b = right.withColumn("_rbin", F.explode(I.bins(F.col("r_start"), F.col("r_end"), width))).withColumnRenamed("chrom", "_chrom")
    met = I.overlaps(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end"), insertion_aware)
    first = F.floor(F.greatest(F.least("start", "end"), F.least("r_start", "r_end")) / width).cast("int") == F.col("_bin")
    return a.join(b, (F.col("chrom") == F.col("_chrom")) & (F.col("_bin") == F.col("_rbin")) & met & first).drop("_bin", "_rbin", "_chrom")


def carried(rows: DataFrame, value: Column, bins: DataFrame) -> DataFrame:
    """Per (chrom, _bin) of ``bins`` the greatest ``value`` of the rows in earlier bins of the chromosome, null if none.

    One row per bin goes through the chromosome's window, so no task orders its rows.
    """
    last = rows.groupBy("chrom", "_bin").agg(F.max(value).alias("_last"))
    every = bins.select("chrom", "_bin").distinct().join(last, ["chrom", "_bin"], "full")
    w = W.partitionBy("chrom").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    return every.select("chrom", "_bin", F.last("_last", True).over(w).alias("_carried"))


def as_of(points: DataFrame, regions: DataFrame, pos: str = "pos", width: int = 100_000) -> DataFrame:
    """Points with the last region (chrom, start, end) that starts at or before them, null if none.

    A union and a running last value in each bin, and what earlier bins leave over: no
    pairs. Of regions with one start the longest counts.
    """
    one = regions.groupBy("chrom", "start").agg(F.max("end").alias("end")).withColumn("_bin", I.bin_of(F.col("start"), width))
    rows = points.select("chrom", F.col(pos).alias("_at"), F.lit(1).alias("_kind"), I.bin_of(F.col(pos), width).alias("_bin"), F.lit(None).cast("struct<start:int,end:int>").alias("_region"), F.struct(*points.columns).alias("_row"))
    marks = one.select("chrom", F.col("start").alias("_at"), F.lit(0).alias("_kind"), "_bin", F.struct("start", "end").alias("_region"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    w = W.partitionBy("chrom", "_bin").orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, 0)
    found = marks.unionByName(rows).withColumn("_here", F.last("_region", True).over(w)).where("_kind = 1")
    found = found.join(carried(one, F.struct("start", "end"), rows), ["chrom", "_bin"], "left").withColumn("_region", F.coalesce("_here", "_carried"))
    return found.select("_row.*", F.col("_region.start").alias("region_start"), F.col("_region.end").alias("region_end"))


def in_valid_region(points: DataFrame, regions: DataFrame, pos: str = "pos") -> DataFrame:
    """Points with ``valid``: inside the region as of their position; chromosomes without regions stay valid."""
    known = regions.select("chrom").distinct().withColumn("_known", F.lit(True))
    found = as_of(points, regions, pos).join(small(known), "chrom", "left")
    return found.withColumn("valid", F.col("_known").isNull() | F.coalesce(F.col("region_end") >= F.col(pos), F.lit(False))).drop("_known")
