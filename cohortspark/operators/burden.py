"""Case/control burden: affected samples of rare variants per transcript."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gene_burden(variants: DataFrame, affected: DataFrame, cases: DataFrame, controls: DataFrame, keys: list[str]) -> DataFrame:
    """Per transcript the gene, and the affected case and control samples, ascending.

    ``variants``: keys, gene, transcript of the surviving consequences; ``affected``: keys,
    sample_id. Transcripts without affected samples stay, with empty lists. Affected
    samples are marked before the join, so sample lists are gathered after one shuffle
    by transcript with partial sets made before it.
    """
    marked = affected.join(cases.select("sample_id", F.lit(True).alias("_case")), "sample_id", "left").join(controls.select("sample_id", F.lit(True).alias("_control")), "sample_id", "left")
    rows = variants.join(marked.where("_case OR _control"), keys, "left")
    ids = lambda flag: F.array_sort(F.collect_set(F.when(F.col(flag), F.col("sample_id"))))
    return rows.groupBy("transcript").agg(F.max("gene").alias("gene"), ids("_case").alias("cases"), ids("_control").alias("controls"))


def gene_samples(variants: DataFrame, affected: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct affected samples per gene."""
    return variants.select("gene", *keys).distinct().join(affected, keys).groupBy("gene").agg(F.array_sort(F.collect_set("sample_id")).alias("sample_ids"))


def by_cohort(summary: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Number of a gene's samples in each cohort."""
    return summary.select("gene", F.explode("sample_ids").alias("sample_id")).join(cohorts, "sample_id").groupBy("gene", "cohort").agg(F.count("*").alias("n"))


def merge_summaries(*parts: DataFrame) -> DataFrame:
    """Summaries of several runs united per transcript."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return rows.groupBy("transcript").agg(F.max("gene").alias("gene"), union("cases").alias("cases"), union("controls").alias("controls"))


def sizes(summary: DataFrame) -> DataFrame:
    return summary.select("transcript", "gene", F.size("cases").alias("n_cases"), F.size("controls").alias("n_controls"))


def missense_share(variants: DataFrame, term: Column) -> DataFrame:
    """Variants with a missense consequence, and all."""
    return variants.agg(F.count_if(term == "missense_variant").alias("missense"), F.count("*").alias("total"))
