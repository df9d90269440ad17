"""Readers: tables, regions, sample collections, allow-lists, BED and FASTA."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.operators.filters import stored_frequency_below
from cohortspark.schemas import schema


def parse_region(text: str) -> tuple[str, int, int]:
    """``chrom:start-end``."""
    m = re.fullmatch(r"\s*([^:\s]+):(\d+)-(\d+)\s*", text)
    if not m or int(m[2]) > int(m[3]):
        raise ValueError(f"not a region: {text!r}")
    return m[1], int(m[2]), int(m[3])


def read_table(spark: SparkSession, path: str, record: str) -> DataFrame:
    """A Parquet table of a record type, with its schema given and never inferred."""
    return spark.read.schema(schema(record)).parquet(path)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """An Avro file, where Spark has the module."""
    return spark.read.format("avro").load(path)


def has_avro(spark: SparkSession) -> bool:
    try:
        spark.read.format("avro").load("file:///nonexistent")
    except Exception as e:
        return "avro" not in str(e).lower() or "PATH_NOT_FOUND" in str(e)
    return True


def read_sample_collection(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Samples (sample_id, name) and cohorts (cohort, sample_id) of a sample-collection JSON."""
    rows = spark.read.schema(schema("sample_collection")).option("mode", "FAILFAST").json(path)
    samples = rows.select(F.explode("samples").alias("id", "name")).select(F.col("id").cast("int").alias("sample_id"), "name")
    cohorts = rows.select(F.explode("cohorts").alias("cohort", "ids")).select("cohort", F.explode("ids").alias("sample_id"))
    return samples, cohorts


def read_pos_ref_alt(spark: SparkSession, path: str) -> DataFrame:
    """Four tab-separated columns chrom, pos, ref, alt; blank lines are skipped, other widths raise."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    p = F.split("value", "\t", -1)
    checked = F.when(F.size(p) == 4, p).otherwise(F.raise_error(F.concat(F.lit("not four columns: "), F.col("value"))).cast("array<string>"))
    return lines.select(checked.alias("p")).select(F.trim(F.col("p")[0]).alias("chrom"), F.trim(F.col("p")[1]).cast("int").alias("pos"), F.trim(F.col("p")[2]).alias("ref"), F.trim(F.col("p")[3]).alias("alt"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """Three columns chrom, start, end; malformed lines are skipped."""
    p = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where((F.size(p) == 3) & F.get(p, F.lit(1)).try_cast("int").isNotNull() & F.get(p, F.lit(2)).try_cast("int").isNotNull())
    return rows.select(F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(1)).cast("int").alias("start"), F.get(p, F.lit(2)).cast("int").alias("end"))


def fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of FASTA files with file, chromosome and the 0-based position of their first base.

    One row per sequence, not per file: sequences are split at ``>``, so a genome is dealt
    over tasks by chromosome.
    """
    rows = spark.read.option("lineSep", ">").text(path).where(F.length(F.trim("value")) > 0)
    lines = F.transform(F.split("value", "\n"), lambda x: F.trim(x))
    # named before the lines are dealt out: beside posexplode the name would be split off the whole sequence once a line
    named = rows.select(F.get(F.split(F.trim(F.substring_index("value", "\n", 1)), " "), F.lit(0)).alias("chrom"), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))).alias("lines"))
    one = named.select("chrom", F.posexplode("lines").alias("nr", "line"))
    w = W.partitionBy("chrom").orderBy("nr").rowsBetween(W.unboundedPreceding, -1)
    return one.select("chrom", "nr", "line", F.coalesce(F.sum(F.length("line")).over(w), F.lit(0)).cast("int").alias("pos")).where(F.length("line") > 0)


def known_blocks(lines: DataFrame) -> DataFrame:
    """Stretches of whole lines that aren't all N (chrom, start, end): gaps and islands over the lines' order."""
    n = lines.withColumn("known", F.length(F.regexp_replace("line", "N", "")) > 0)
    w = W.partitionBy("chrom").orderBy("nr")
    turn = n.withColumn("block", F.sum((F.col("known") != F.coalesce(F.lag("known").over(w), ~F.col("known"))).cast("int")).over(w))
    return turn.where("known").groupBy("chrom", "block").agg(F.min("pos").alias("start"), F.max(F.col("pos") + F.length("line")).cast("int").alias("end")).drop("block")


def reference_and_variants(reference: DataFrame, counts: DataFrame) -> DataFrame:
    """Positions that have both a reference row and variant rows."""
    return reference.join(counts, ["chrom", "pos"], "inner")


def for_samples(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """Rows of the given samples only."""
    return rows.join(samples.select("sample_id"), "sample_id", "left_semi")


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """Stored cohort statistics."""
    return spark.read.schema(schema("variant_stats")).parquet(path)


def frequency_scan(analysis: DataFrame, cutoff: float, frequency: str = "maf") -> DataFrame:
    """Rows of a stored analysis table under the cut-off; a missing frequency passes. The test is on a flat column, so it is pushed."""
    return analysis.where(stored_frequency_below(F.col(frequency), cutoff))
