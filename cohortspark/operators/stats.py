"""Cohort statistics of variants: allele counts and frequencies, rates, genotype histograms, exact tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.hwe import exact_p

from .joins import small
from .merge import BASES, VARIANT, by_variant

NAN = float("nan")


def _float(top: Column, bottom: Column) -> Column:
    """A quotient as a 32-bit float, NaN for nothing of nothing."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")).cast("float"), F.lit(NAN).cast("float"))


def frequencies(ref_count: Column, total: Column, ref: Column, alt: Column, alt_count: Column) -> dict[str, Column]:
    """Minor allele and its frequency; the reference counts as minor on a tie."""
    rf, af = _float(ref_count, total), _float(alt_count, total)
    alt_minor = ~F.isnan(rf) & (rf > af)
    return {"ref_af": rf, "alt_af": af, "maf": F.when(alt_minor, af).otherwise(rf), "maf_allele": F.when(alt_minor, alt).otherwise(ref)}


def rates(n: Column, no_call: Column, not_pass: Column) -> dict[str, Column]:
    """Call rate, pass rate and their product as 32-bit floats; all 1 without samples."""
    one = F.lit(1.0).cast("float")
    rate = lambda x: F.when(n == 0, one).otherwise(_float(n - x, n))
    call, ok = rate(no_call), rate(not_pass)
    return {"call_rate": call, "pass_rate": ok, "opr": (call * ok).cast("float")}


#: What is counted of a merged row and added up per variant.
COUNTS = ("alt_ac", "other_ac", "ref1", "no_call", "mentioned", "not_pass")


def counted() -> list[Column]:
    """Sums of ``COUNTS`` over merged rows.

    A no-call counts only where the sample has no alternate; insertions beside a variant
    that isn't one don't count.
    """
    secs = [F.coalesce(F.col(f"sec_{x}"), F.lit(0)) for x in BASES] + [F.coalesce("sec_del", F.lit(0)), F.when(F.col("type") == "INSERTION", F.coalesce("sec_ins", F.lit(0))).otherwise(0)]
    others = sum(secs, F.lit(0))
    ref1 = F.coalesce(F.col("reference") == 1, F.lit(False))
    no_call = F.coalesce(F.col("reference") == -1, F.lit(False)) & (F.col("a") == 0) & (others == 0)
    mentioned = ref1 | no_call | (F.col("a") > 0) | (others > 0)
    return [F.sum("a").alias("alt_ac"), F.sum(others).alias("other_ac"), F.count_if(ref1).alias("ref1"), F.count_if(no_call).alias("no_call"), F.count_if(mentioned).alias("mentioned"), F.count_if(F.coalesce("not_pass", F.lit(False))).alias("not_pass")]


def cohort_sets(cohorts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The set of cohorts that each sample is in (sample_id, _set), and the cohorts of each set (_set, cohort)."""
    members = cohorts.groupBy("sample_id").agg(F.sort_array(F.collect_list("cohort")).alias("_cohorts"))
    sets = members.groupBy("_cohorts").agg(F.min("sample_id").alias("_set"))
    return members.join(sets, "_cohorts").select("sample_id", "_set"), sets.select("_set", F.explode("_cohorts").alias("cohort"))


def cohort_statistics(merged: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Per variant and cohort: counts, frequencies and rates over merged long rows.

    Samples without a row are hom-ref and diploid, so they are counted by subtraction.
    Cohorts are joined to their members, never crossed: rows are counted by the set of
    cohorts that a sample is in, and the sums go to each of them.
    """
    members, _ = cohort_sets(cohorts)
    return set_statistics(merged.join(small(members), "sample_id").groupBy(*by_variant(merged), "type", "_set").agg(*counted()), cohorts)


def set_statistics(by_set: DataFrame, cohorts: DataFrame) -> DataFrame:
    """``cohort_statistics`` of rows that are counted (``COUNTS``) by the set of cohorts."""
    sizes = cohorts.groupBy("cohort").agg(F.count("*").alias("num_samples"))
    _, sets = cohort_sets(cohorts)
    g = by_set.join(small(sets), "_set").groupBy(*by_variant(by_set), "type", "cohort").agg(*(F.sum(c).cast("int").alias(c) for c in COUNTS))
    g = g.join(small(sizes), "cohort").withColumn("num_samples", F.col("num_samples").cast("int"))
    g = g.withColumn("ref_ac", 2 * (F.col("num_samples") - F.col("mentioned")) + F.col("ref1"))
    g = g.withColumn("total_ac", F.col("ref_ac") + F.col("alt_ac") + F.col("other_ac"))
    g = g.withColumns(frequencies(F.col("ref_ac"), F.col("total_ac"), F.col("ref"), F.col("alt"), F.col("alt_ac")))
    return g.withColumns(rates(F.col("num_samples"), F.col("no_call"), F.col("not_pass")))


def called_statistics(calls: DataFrame, cohorts: DataFrame) -> DataFrame:
    """The same from genotypes (sample_id, chrom, pos, gt, pass) of covered samples only."""
    gt = F.col("gt")
    alt = F.size(F.filter(F.split(gt, "/"), lambda x: x == "1"))
    ref = F.size(F.filter(F.split(gt, "/"), lambda x: x == "0"))
    g = calls.join(cohorts, "sample_id").groupBy("chrom", "pos", "cohort").agg(
        F.count("*").cast("int").alias("num_samples"), F.sum(ref).cast("int").alias("ref_ac"), F.sum(alt).cast("int").alias("alt_ac"), F.count_if(gt.contains(".")).cast("int").alias("no_call"), F.count_if(~F.col("pass")).cast("int").alias("not_pass")
    )
    total = F.col("ref_ac") + F.col("alt_ac")
    f = frequencies(F.col("ref_ac"), total, F.lit("R"), F.lit("A"), F.col("alt_ac"))
    return g.withColumns({"maf": f["maf"], "maf_allele": f["maf_allele"]}).withColumns(rates(F.col("num_samples"), F.col("no_call"), F.col("not_pass")))


def genotype_histogram(genotypes: DataFrame, cohorts: DataFrame, keys: list[str]) -> DataFrame:
    """Samples per key, cohort and genotype."""
    return genotypes.join(cohorts, "sample_id").groupBy(*keys, "cohort", "gt").agg(F.count("*").cast("int").alias("n"))


def histogram_summary(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """Histogram as a map with the smallest genotype frequency: no-calls count above the line, not below it."""
    g = histogram.groupBy(*keys, "cohort").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("gt", "n")))).alias("gt_counts"), F.min(F.when(F.col("n") > 0, F.col("n"))).alias("_least"), F.sum(F.when(~F.col("gt").contains("."), F.col("n")).otherwise(0)).alias("_called")
    )
    return g.withColumn("mgf", _float(F.col("_least"), F.col("_called"))).drop("_least", "_called")


def hardy_weinberg(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """Exact p per key and cohort; the test runs once per distinct triple of counts."""
    n = lambda gt: F.sum(F.when(F.col("gt") == gt, F.col("n")).otherwise(0)).cast("int")
    wide = histogram.groupBy(*keys, "cohort").agg(n("1/1").alias("hom_alt"), n("0/1").alias("het"), n("0/0").alias("hom_ref"))
    triple = ["hom_alt", "het", "hom_ref"]
    once = wide.select(*triple).distinct().withColumn("hwe", exact_p(*map(F.col, triple)))
    return wide.join(once, triple)


def weighted_count(lists: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of allele numbers over sample entries; an allele below 1 raises."""
    checked = F.when(F.col("allele") < 1, F.raise_error(F.lit("allele below 1")).cast("int")).otherwise(F.col("allele"))
    return lists.groupBy(*keys).agg(F.sum(checked).alias("n"))


#: Cut-offs of the overall pass rate.
OPR_CUTS = {"n_08": 0.8, "n_09": 0.9, "n_095": 0.95}


def type_summary(rows: DataFrame) -> DataFrame:
    """Variants per type, all and those at or above each overall pass rate."""
    return rows.groupBy("type").agg(F.count("*").alias("n"), *(F.count_if(F.col("opr") >= v).alias(k) for k, v in OPR_CUTS.items()))


def slot_counts(counts: DataFrame) -> DataFrame:
    """Entries per slot of the count table."""
    return counts.groupBy("slot").agg(F.count("*").alias("n"))


def no_call_and_fail(lists: DataFrame) -> DataFrame:
    """Totals over rows with both lists: no-call samples that also fail, and those that don't."""
    both = lists.where((F.size("no_call") > 0) & (F.size("failed") > 0))
    return both.agg(F.coalesce(F.sum(F.size(F.array_intersect("no_call", "failed"))), F.lit(0)).alias("both"), F.coalesce(F.sum(F.size(F.array_except("no_call", "failed"))), F.lit(0)).alias("only_no_call"), F.count("*").alias("n_rows"))


def annotation_rollup(annotated: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct terms, biotypes and genes of a variant's consequences, and its highest scaled score."""
    distinct = lambda c: F.array_sort(F.collect_set(c))
    return annotated.groupBy(*keys).agg(distinct("so_term").alias("terms"), distinct("biotype").alias("biotypes"), distinct("gene").alias("genes"), F.max("cadd_scaled").alias("cadd_scaled"))
