"""Writers: partitioned tables, exports, sample collections and VCF text."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.functions.genotype import decimal


#: Positions that are written by one task.
STRETCH = 1 << 16


def write_regions(regions: DataFrame, path: str, mode: str = "append") -> None:
    """Region rows by chromosome and bin: a load appends files, a reader prunes both."""
    regions.repartition("chrom", "bin").write.mode(mode).partitionBy("chrom").parquet(path)


def write_variants(rows: DataFrame, path: str, mode: str = "overwrite", pos: str = "pos") -> None:
    """Variant rows by chromosome, sorted by position in each file, so position ranges prune row groups.

    With dynamic overwrite a recomputed chromosome replaces its own files only.
    """
    # ranges are found by a run of all that makes the rows, so positions are dealt by stretch instead
    dealt = rows.repartition("chrom", F.floor(F.col(pos) / STRETCH)) if pos == "pos" else rows.repartitionByRange("chrom", pos)
    sorted_ = dealt.sortWithinPartitions("chrom", pos)
    sorted_.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("chrom").parquet(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """Cohort statistics by cohort and chromosome, sorted by frequency in each file, so a cut-off prunes row groups."""
    dealt = stats.repartitionByRange("cohort", "chrom", "maf").sortWithinPartitions("cohort", "chrom", "maf")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cohort", "chrom").parquet(path)


def write_analysis(rows: DataFrame, path: str, frequency: str = "maf") -> None:
    """Variants with a control's frequency as a flat column, sorted by it: a map's values wouldn't be pushed to."""
    write_variants(rows, path, pos=frequency)


def write_summary(summary: DataFrame, path: str) -> None:
    """Gene summaries, Snappy."""
    summary.write.mode("overwrite").option("compression", "snappy").parquet(path)


def sample_collection(samples: DataFrame, cohorts: DataFrame) -> DataFrame:
    """One row: id to name, and cohort to ids (the study's metadata)."""
    names = samples.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("sample_id").cast("string"), "name")))).alias("samples"))
    ids = cohorts.groupBy("cohort").agg(F.array_sort(F.collect_list("sample_id")).alias("ids")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cohort", "ids")))).alias("cohorts"))
    return names.join(F.broadcast(ids))


def write_sample_collection(samples: DataFrame, cohorts: DataFrame, path: str) -> None:
    sample_collection(samples, cohorts).write.mode("overwrite").json(path)


def sidecar(config: dict) -> str:
    """A study configuration as JSON text."""
    return json.dumps(config, sort_keys=True)


def export_rows(genotypes: DataFrame, stats: DataFrame, annotations: DataFrame) -> DataFrame:
    """Export records: genotype classes, cohort statistics as a map, and the rolled-up annotation."""
    keys = ["chrom", "pos", "ref", "alt"]
    by_cohort = stats.groupBy(*keys).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("cohort", F.struct(F.col("ref_ac").alias("refAlleleCount"), F.col("alt_ac").alias("altAlleleCount"), "maf", F.col("maf_allele").alias("mafAllele"), F.col("num_samples").alias("numSamples"), F.col("opr").alias("overallPassrate")))))).alias("stats")
    )
    return genotypes.join(by_cohort, keys, "left").join(annotations, keys, "left")


#: Headers of the cohort fields.
INFO = {"OPR": "Overall pass rate", "CR": "Call rate", "PR": "Pass rate", "HWE": "Hardy-Weinberg p-value", "AF": "Allele frequency"}


def vcf_header(cohorts: list[str], samples: list[str] = (), contigs: list[str] = ()) -> list[str]:
    lines = ["##fileformat=VCFv4.2", *(f"##contig=<ID={c}>" for c in contigs)]
    lines += [f'##INFO=<ID={c}_{k},Number=1,Type=Float,Description="{text} in cohort {c}">' for c in cohorts for k, text in INFO.items()]
    return [*lines, '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">', "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", *(["FORMAT", *samples] if samples else [])])]


def info_field(stats: DataFrame, keys: list[str]) -> DataFrame:
    """The INFO text per variant: each cohort's rates, three digits, the test with seven."""
    part = F.array_join(F.array(*(F.concat(F.col("cohort"), F.lit(f"_{k}="), v) for k, v in (("OPR", decimal(F.col("opr"), 3)), ("CR", decimal(F.col("call_rate"), 3)), ("PR", decimal(F.col("pass_rate"), 3)), *((("HWE", decimal(F.col("hwe"), 7)),) if "hwe" in stats.columns else ())))), ";")
    return stats.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cohort", part.alias("part")))), lambda x: x["part"]), ";").alias("info"))


def vcf_lines(rows: DataFrame) -> DataFrame:
    """Variant rows (chrom, pos, ref, alt, info) as VCF text; an empty allele is written as ``N`` before the change."""
    ref, alt = F.col("ref"), F.col("alt")
    blank = (F.length(ref) == 0) | (F.length(alt) == 0)
    pad = lambda x: F.when(blank, F.concat(F.lit("N"), x)).otherwise(x)
    at = F.when(blank, F.col("pos") - 1).otherwise(F.col("pos"))
    return rows.select("chrom", at.alias("pos"), F.concat_ws("\t", "chrom", at.cast("string"), F.lit("."), pad(ref), pad(alt), F.lit("."), F.lit("."), F.coalesce("info", F.lit("."))).alias("line"))


def write_vcf(spark: SparkSession, rows: DataFrame, path: str, cohorts: list[str]) -> None:
    """VCF text in parts ordered by chromosome and position; the header is a first part of its own."""
    spark.createDataFrame([(x,) for x in vcf_header(cohorts)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/header")
    body = vcf_lines(rows).repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos")
    body.select("line").write.mode("overwrite").text(f"{path}/body")


def dead_rows(table: DataFrame, keep: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that a rewrite with ``keep`` drops."""
    return table.join(keep.select(*keys).distinct(), keys, "left_anti")
