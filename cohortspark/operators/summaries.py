"""What an export tells of a variant, gathered in one pass over its genotypes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import genotypes as GT
from . import stats
from .joins import small
from .merge import VARIANT, by_variant


def variant_summaries(genotypes: DataFrame, cohorts: DataFrame, cohort: DataFrame) -> DataFrame:
    """A row per variant: type, alleles, the ``entries`` of ``cohort`` and ``sets``, the counts by set of cohorts.

    ``genotypes``: merged rows with their genotypes. Rows that keep their bin are gathered
    where they are; ``classes`` and ``statistics`` read the result.
    """
    keys = [*by_variant(genotypes), "type"]
    members, _ = stats.cohort_sets(cohorts)
    rows = GT.of_cohort(genotypes, cohort).join(small(members), "sample_id", "left")
    by_set = rows.groupBy(*keys, "_set").agg(F.first("alleles").alias("alleles"), F.collect_set("_entry").alias("entries"), F.max("_inside").alias("met"), *stats.counted())
    counts = F.when(F.col("_set").isNotNull(), F.struct("_set", *stats.COUNTS))  # a sample may be in no cohort
    every = by_set.groupBy(*keys).agg(F.first("alleles").alias("alleles"), F.flatten(F.collect_list("entries")).alias("entries"), F.max("met").alias("met"), F.collect_list(counts).alias("sets"))
    return every.select(*VARIANT, "type", "alleles", "entries", "met", "sets")


def classes(summaries: DataFrame, cohort: DataFrame) -> DataFrame:
    """``genotype_classes`` of the summaries' cohort."""
    return GT.class_lists(summaries, cohort)


def statistics(summaries: DataFrame, cohorts: DataFrame) -> DataFrame:
    """``cohort_statistics`` of the summaries' cohorts."""
    return stats.set_statistics(summaries.select(*VARIANT, "type", F.inline("sets")), cohorts)
