"""Queries of filters, statistics and the case/control burden."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortspark.functions import genotype as G
from cohortspark.operators import burden, filters, stats
from cohortspark.sources import adapters as A
from cohortspark.sources import readers, sinks

from .config import ExportConfig
from .queries_scan import scratch
from .query import VariantQuery
from .registry import query

STATS = """
, s AS (SELECT c.chrom, c.pos, h.cohort, count(*) n, CAST(sum(CASE gt WHEN '0/0' THEN 2 WHEN '0' THEN 1 WHEN '0/1' THEN 1 ELSE 0 END) AS INT) ref_ac, CAST(sum(CASE gt WHEN '1/1' THEN 2 WHEN '0/1' THEN 1 ELSE 0 END) AS INT) alt_ac,
  count(*) FILTER (WHERE gt = './.') nc, count(*) FILTER (WHERE NOT pass) np FROM calls c JOIN cohorts h USING (sample_id) GROUP BY 1, 2, 3),
f AS (SELECT *, CASE WHEN ref_ac + alt_ac > 0 THEN CAST(CAST(ref_ac AS DOUBLE) / (ref_ac + alt_ac) AS FLOAT) END rf, CASE WHEN ref_ac + alt_ac > 0 THEN CAST(CAST(alt_ac AS DOUBLE) / (ref_ac + alt_ac) AS FLOAT) END af,
  CAST(CAST(n - nc AS DOUBLE) / n AS FLOAT) cr, CAST(CAST(n - np AS DOUBLE) / n AS FLOAT) pr FROM s),
m AS (SELECT *, CASE WHEN rf > af THEN af ELSE rf END maf, CAST(cr * pr AS FLOAT) opr FROM f)""".lstrip()


def _stats(spark: SparkSession, d: str) -> DataFrame:
    """Cohort statistics with a NaN frequency as null, for comparison with SQL."""
    s = stats.called_statistics(A.calls(spark, d), A.cohorts(spark, d))
    return s.withColumn("maf", F.when(~F.isnan("maf"), F.col("maf")))


@query("agg_1_allele_frequency", "calls cohorts", STATS + " SELECT chrom, pos, cohort, ref_ac, alt_ac, round(CAST(maf AS DOUBLE), 6) AS maf, round(CAST(cr AS DOUBLE), 6) AS call_rate, round(CAST(pr AS DOUBLE), 6) AS pass_rate, round(CAST(opr AS DOUBLE), 5) AS opr FROM m")
def agg_1(spark: SparkSession, d: str) -> DataFrame:
    r = lambda c, k=6: F.round(F.col(c).cast("double"), k).alias(c)
    return _stats(spark, d).select("chrom", "pos", "cohort", "ref_ac", "alt_ac", r("maf"), r("call_rate"), r("pass_rate"), r("opr", 5))


@query("join_10_agg_5_cohort_loop", "calls cohorts", "SELECT cohort, count(*) AS n, count(DISTINCT pos) AS positions FROM calls JOIN cohorts USING (sample_id) GROUP BY cohort")
def join_10(spark: SparkSession, d: str) -> DataFrame:
    """Variants by cohorts through the members: the members are joined, nothing is crossed."""
    return A.calls(spark, d).join(A.cohorts(spark, d), "sample_id").groupBy("cohort").agg(F.count("*").alias("n"), F.countDistinct("pos").alias("positions"))


@query("join_11_hom_ref_by_subtraction", "calls cohorts", "SELECT chrom, pos, (SELECT count(*) FROM cohorts WHERE cohort = 'ALL') - count(*) FILTER (WHERE gt NOT IN ('0/0')) AS hom_ref FROM calls GROUP BY 1, 2")
def join_11(spark: SparkSession, d: str) -> DataFrame:
    n = A.cohorts(spark, d).where("cohort = 'ALL'").agg(F.count("*").alias("size"))
    seen = A.calls(spark, d).groupBy("chrom", "pos").agg(F.count_if(F.col("gt") != "0/0").alias("seen"))
    return seen.join(F.broadcast(n)).select("chrom", "pos", (F.col("size") - F.col("seen")).alias("hom_ref"))


@query("agg_2_genotype_histogram", "calls cohorts", "SELECT chrom, pos, cohort, gt, CAST(count(*) AS INT) AS n FROM calls JOIN cohorts USING (sample_id) GROUP BY 1, 2, 3, 4")
def agg_2(spark: SparkSession, d: str) -> DataFrame:
    return stats.genotype_histogram(A.calls(spark, d), A.cohorts(spark, d), ["chrom", "pos"])


@query("agg_2_smallest_genotype_frequency", "calls cohorts", """
, h AS (SELECT chrom, pos, cohort, gt, count(*) n FROM calls JOIN cohorts USING (sample_id) GROUP BY 1, 2, 3, 4)
SELECT chrom, pos, cohort, CASE WHEN sum(n) FILTER (WHERE gt <> './.') > 0 THEN round(CAST(CAST(min(n) AS DOUBLE) / sum(n) FILTER (WHERE gt <> './.') AS FLOAT)::DOUBLE, 6) END AS mgf FROM h GROUP BY 1, 2, 3""".lstrip())
def agg_2b(spark: SparkSession, d: str) -> DataFrame:
    h = stats.histogram_summary(agg_2(spark, d), ["chrom", "pos"])
    ok = ~F.isnan("mgf") & (F.col("mgf") < float("inf"))
    return h.select("chrom", "pos", "cohort", F.when(ok, F.round(F.col("mgf").cast("double"), 6)).alias("mgf"))


HWE_COHORTS = """
, g AS (SELECT chrom, pos, cohort, CAST(count(*) FILTER (WHERE gt = '1/1') AS INT) hom_alt, CAST(count(*) FILTER (WHERE gt = '0/1') AS INT) het, CAST(count(*) FILTER (WHERE gt = '0/0') AS INT) hom_ref FROM calls JOIN cohorts USING (sample_id) GROUP BY 1, 2, 3),
k AS (SELECT DISTINCT least(hom_alt, hom_ref) aa, het ab, greatest(hom_alt, hom_ref) bb FROM g),
e AS (SELECT k.*, aa + ab + bb n, 2 * aa + ab rare, h FROM k, unnest(range((2 * aa + ab) % 2, 2 * aa + ab + 1, 2)) u(h) WHERE aa + ab + bb > 0),
w AS (SELECT *, h * ln(2) - lgamma((rare - h) // 2 + 1) - lgamma(h + 1) - lgamma(n - h - (rare - h) // 2 + 1) lp FROM e),
z AS (SELECT *, exp(lp - max(lp) OVER (PARTITION BY aa, ab, bb)) p FROM w),
r AS (SELECT aa, ab, bb, sum(p) FILTER (WHERE h >= ab) / sum(p) top, sum(p) FILTER (WHERE h <= ab) / sum(p) oth FROM z GROUP BY 1, 2, 3)
SELECT chrom, pos, cohort, hom_alt, het, hom_ref, round(CASE WHEN hom_alt + het + hom_ref < 1 THEN -1 WHEN top > 0.5 AND oth > 0.5 THEN 1.0 ELSE 2 * least(top, oth) END, 6) AS hwe
FROM g LEFT JOIN r ON aa = least(hom_alt, hom_ref) AND ab = het AND bb = greatest(hom_alt, hom_ref)""".lstrip()


@query("agg_3_hardy_weinberg_cohorts", "calls cohorts", HWE_COHORTS)
def agg_3(spark: SparkSession, d: str) -> DataFrame:
    return stats.hardy_weinberg(agg_2(spark, d), ["chrom", "pos"]).select("chrom", "pos", "cohort", "hom_alt", "het", "hom_ref", F.round("hwe", 6).alias("hwe"))


@query("agg_4_weighted_count", "calls", "SELECT chrom, pos, CAST(sum(CASE gt WHEN '1/1' THEN 2 ELSE 1 END) AS BIGINT) AS n FROM calls WHERE gt IN ('0/1', '1/1') GROUP BY 1, 2")
def agg_4(spark: SparkSession, d: str) -> DataFrame:
    lists = A.calls(spark, d).where(F.col("gt").isin("0/1", "1/1")).withColumn("allele", F.when(F.col("gt") == "1/1", 2).otherwise(1))
    return stats.weighted_count(lists, ["chrom", "pos"])


@query("agg_6_type_summary", "records", """
, o AS (SELECT CASE WHEN typ = 'INDEL' THEN CASE WHEN rstart > rend THEN 'INSERTION' ELSE 'DELETION' END ELSE typ END AS type, CAST(count(*) FILTER (WHERE gt <> './.') AS DOUBLE) / count(*) * (CAST(count(*) FILTER (WHERE coalesce(filt = 'PASS', false)) AS DOUBLE) / count(*)) opr FROM records GROUP BY chrom, rstart, ref, alt, 1)
SELECT type, count(*) AS n, count(*) FILTER (WHERE opr >= 0.8) AS n_08, count(*) FILTER (WHERE opr >= 0.9) AS n_09, count(*) FILTER (WHERE opr >= 0.95) AS n_095 FROM o GROUP BY 1""".lstrip())
def agg_6(spark: SparkSession, d: str) -> DataFrame:
    """Types by the alleles of each variant of the records."""
    share = lambda when: F.count_if(when).cast("double") / F.count("*")
    o = A.records(spark, d).groupBy("chrom", "start", "ref", "alt").agg((share(F.col("gt") != "./.") * share(G.is_pass(F.col("filter")))).alias("opr"))
    return stats.type_summary(o.withColumn("type", G.infer_type(F.col("ref"), F.col("alt"))))


@query("agg_9_slot_counts", "calls", "SELECT gt AS slot, count(*) AS n FROM calls GROUP BY 1")
def agg_9(spark: SparkSession, d: str) -> DataFrame:
    return stats.slot_counts(A.calls(spark, d).withColumnRenamed("gt", "slot"))


@query("agg_10_no_call_and_fail", "calls", """
, r AS (SELECT count(*) FILTER (WHERE gt = './.' AND NOT pass) b, count(*) FILTER (WHERE gt = './.' AND pass) o, count(*) FILTER (WHERE gt = './.') nc, count(*) FILTER (WHERE NOT pass) nf FROM calls GROUP BY chrom, pos)
SELECT CAST(sum(b) AS BIGINT) AS both, CAST(sum(o) AS BIGINT) AS only_no_call, count(*) AS n_rows FROM r WHERE nc > 0 AND nf > 0""".lstrip())
def agg_10(spark: SparkSession, d: str) -> DataFrame:
    ids = lambda when: F.collect_set(F.when(when, F.col("sample_id")))
    lists = A.calls(spark, d).groupBy("chrom", "pos").agg(ids(F.col("gt") == "./.").alias("no_call"), ids(~F.col("pass")).alias("failed"))
    return stats.no_call_and_fail(lists)


@query("agg_12_counts", "calls variants", "SELECT (SELECT count(*) FROM calls) AS calls, (SELECT count(*) FROM variants) AS variants")
def agg_12(spark: SparkSession, d: str) -> DataFrame:
    return A.calls(spark, d).agg(F.count("*").alias("calls")).join(F.broadcast(A.variants(spark, d).agg(F.count("*").alias("variants"))))


@query("agg_13_annotation_rollup", "variants", "SELECT gene, string_agg(DISTINCT so_term, ',' ORDER BY so_term) AS terms, string_agg(DISTINCT biotype, ',' ORDER BY biotype) AS biotypes, max(cadd_scaled) AS cadd_scaled FROM variants GROUP BY gene")
def agg_13(spark: SparkSession, d: str) -> DataFrame:
    r = stats.annotation_rollup(A.variants(spark, d).withColumn("id", F.col("gene")), ["id"])
    return r.select(F.col("id").alias("gene"), F.array_join("terms", ",").alias("terms"), F.array_join("biotypes", ",").alias("biotypes"), "cadd_scaled")


CONTROL = "m.cohort = 'MIDDLE EAST'"
RARE = "coalesce(NOT isnan(maf) AND maf < CAST(0.2 AS FLOAT), false) AND opr >= CAST(0.4 AS FLOAT)"


def _with_control(spark: SparkSession, d: str) -> DataFrame:
    control = _stats(spark, d).where("cohort = 'MIDDLE EAST'").select("chrom", "pos", "maf", "opr")
    return A.variants(spark, d).join(control, ["chrom", "pos"], "left")


def _f(x: float) -> F.Column:
    return F.lit(x).cast("float")


@query("src_4_maf_prefilter", "calls cohorts variants", STATS + f" SELECT v.chrom, v.pos FROM variants v LEFT JOIN m ON m.chrom = v.chrom AND m.pos = v.pos AND {CONTROL} WHERE maf IS NULL OR maf < CAST(0.1 AS FLOAT)")
def src_4(spark: SparkSession, d: str) -> DataFrame:
    """The analysis table is written with the control's frequency as a flat, sorted column; the cut-off reaches its row groups."""
    path = scratch(spark, "analysis")
    sinks.write_analysis(_with_control(spark, d).select("chrom", "pos", "maf", "opr"), path)
    return readers.frequency_scan(spark.read.schema("pos int, maf float, opr float, chrom string").parquet(path), 0.1).select("chrom", "pos")


@query("src_4_stored_statistics", "calls cohorts", STATS + " SELECT chrom, pos, cohort, round(CAST(maf AS DOUBLE), 6) AS maf FROM m WHERE cohort = 'ASIA' AND maf < CAST(0.1 AS FLOAT)")
def src_4b(spark: SparkSession, d: str) -> DataFrame:
    """Cohort statistics written by cohort and chromosome, sorted by frequency, and scanned below a cut-off."""
    path = scratch(spark, "stats")
    sinks.write_stats(_stats(spark, d).select("chrom", "pos", "cohort", "num_samples", "ref_ac", "alt_ac", "maf", "maf_allele", "call_rate", "pass_rate", "opr"), path)
    rows = readers.read_stats(spark, path).where((F.col("cohort") == "ASIA") & (F.col("maf") < _f(0.1)))
    return rows.select("chrom", "pos", "cohort", F.round(F.col("maf").cast("double"), 6).alias("maf"))


@query("flt_1_control_frequency", "calls cohorts variants", STATS + f" SELECT v.chrom, v.pos FROM variants v JOIN m ON m.chrom = v.chrom AND m.pos = v.pos AND {CONTROL} WHERE maf < CAST(CASE WHEN v.chrom IN ('X', 'chrX') THEN 0.3 ELSE 0.2 END AS FLOAT)")
def flt_1(spark: SparkSession, d: str) -> DataFrame:
    test = filters.frequency_below(F.col("maf"), F.col("chrom"), 0.2, 0.3)
    return _with_control(spark, d).where(test).select("chrom", "pos")


@query("flt_2_overall_pass_rate", "calls cohorts", STATS + " SELECT chrom, pos FROM m GROUP BY 1, 2 HAVING min(CAST(opr AS DOUBLE)) >= CASE WHEN chrom = '7' THEN 0.2 ELSE 0.4 END")
def flt_2(spark: SparkSession, d: str) -> DataFrame:
    s = _stats(spark, d).groupBy("chrom", "pos").agg(F.collect_list(F.col("opr").cast("double")).alias("oprs"))
    return s.where(filters.pass_rate_filter(F.col("oprs"), F.col("chrom"), 0.4, {("7",): 0.2})).select("chrom", "pos")


@query("flt_11_export_pass_rate", "calls cohorts", STATS + " SELECT chrom, pos FROM m WHERE cohort <> 'ALL' GROUP BY 1, 2 HAVING min(CAST(opr AS DOUBLE)) >= 0.3")
def flt_11(spark: SparkSession, d: str) -> DataFrame:
    s = _stats(spark, d).where("cohort <> 'ALL'").groupBy("chrom", "pos").agg(F.collect_list(F.col("opr").cast("double")).alias("oprs"))
    return s.where(filters.pass_rate_filter(F.col("oprs"), F.col("chrom"), 0.3)).select("chrom", "pos")


EXPORT = {"storage.allele.opr.cohorts": "ASIA,EUROPE", "storage.allele.opr.cutoff": "0.3", "storage.allele.opr.x.cohorts": "AFRICA", "storage.allele.opr.x.cutoff": "0.5", "storage.allele.maf.cohorts": "ALL", "storage.allele.maf.cutoff": "0.4", "storage.allele.type.exclude": "NO_VARIATION"}


@query("flt_11_export_filters", "calls cohorts variants", STATS + """, w AS (SELECT chrom, pos, max(CAST(opr AS DOUBLE)) FILTER (WHERE cohort = 'ASIA') a, max(CAST(opr AS DOUBLE)) FILTER (WHERE cohort = 'EUROPE') e, max(CAST(opr AS DOUBLE)) FILTER (WHERE cohort = 'AFRICA') f, max(CAST(maf AS DOUBLE)) FILTER (WHERE cohort = 'ALL') maf FROM m GROUP BY 1, 2)
SELECT CASE WHEN v.chrom = '3' THEN 'X' ELSE v.chrom END AS chrom, v.pos FROM variants v JOIN w USING (chrom, pos) WHERE CASE WHEN v.chrom = '3' THEN coalesce(f >= 0.5, true) ELSE coalesce(a >= 0.3, true) AND coalesce(e >= 0.3, true) END AND coalesce(maf > 0.4, false)""")
def flt_11b(spark: SparkSession, d: str) -> DataFrame:
    """The export's filters as configured: pass rates by cohort with their own for X (here chromosome 3), frequency, types."""
    s = stats.called_statistics(A.calls(spark, d), A.cohorts(spark, d)).select("chrom", "pos", F.struct("cohort", F.struct(F.col("opr").alias("overallPassrate"), "maf")).alias("x"))
    by = s.groupBy("chrom", "pos").agg(F.map_from_entries(F.collect_list("x")).alias("stats"))
    v = A.variants(spark, d).join(by, ["chrom", "pos"]).withColumns({"type": G.infer_type(F.col("ref"), F.col("alt")), "chrom": F.when(F.col("chrom") == "3", "X").otherwise(F.col("chrom"))})
    return ExportConfig.of(EXPORT).apply(v).select("chrom", "pos")


@query("flt_12_common_frequency", "calls cohorts", STATS + " SELECT chrom, pos FROM m GROUP BY 1, 2 HAVING max(CAST(maf AS DOUBLE)) > 0.45")
def flt_12(spark: SparkSession, d: str) -> DataFrame:
    s = stats.called_statistics(A.calls(spark, d), A.cohorts(spark, d)).groupBy("chrom", "pos").agg(F.collect_list(F.col("maf").cast("double")).alias("mafs"))
    return s.where(filters.frequency_above(F.col("mafs"), 0.45)).select("chrom", "pos")


def _annotated(spark: SparkSession, d: str) -> DataFrame:
    """Variants with nested annotation made from their flat columns."""
    v = A.variants(spark, d)
    scores = F.array(
        F.struct(F.lit("sift").alias("source"), F.when(F.col("pos") % 2 == 0, "tolerated").otherwise("deleterious").alias("description")),
        F.struct(F.lit("polyphen").alias("source"), F.when(F.col("pos") % 3 == 0, "benign").otherwise("damaging").alias("description")),
    )
    return v.withColumns({
        "scores": scores,
        "populations": F.array(F.struct(F.lit("EXAC").alias("study"), F.lit("ALL").alias("population"), (F.col("pos") % 100 / 1000.0).alias("af")), F.struct(F.lit("GNOMAD_GENOMES").alias("study"), F.lit("ALL").alias("population"), (F.col("pos") % 50 / 1000.0).alias("af"))),
        "functional": F.array(F.struct(F.lit("cadd_raw").alias("source"), F.lit(99.0).alias("score")), F.struct(F.lit("cadd_scaled").alias("source"), F.col("cadd_scaled").alias("score"))),
        "consequences": F.array(F.struct("so_term", "biotype", scores.alias("scores"))),
    })


@query("flt_3_population_frequency", "variants", "SELECT chrom, pos FROM variants WHERE pos % 100 < 50")
def flt_3(spark: SparkSession, d: str) -> DataFrame:
    a = _annotated(spark, d)
    return a.where(filters.population_below(F.col("populations"), "EXAC", "ALL", 0.05) & filters.population_below(F.col("populations"), "absent", "ALL", 0.05)).select("chrom", "pos")


@query("flt_4_benign", "variants", "SELECT chrom, pos FROM variants WHERE pos % 6 = 0")
def flt_4(spark: SparkSession, d: str) -> DataFrame:
    return _annotated(spark, d).where(filters.any_benign(F.col("consequences"))).select("chrom", "pos")


@query("flt_5_cadd", "variants", "SELECT chrom, pos, cadd_scaled FROM variants WHERE cadd_scaled >= 15")
def flt_5(spark: SparkSession, d: str) -> DataFrame:
    return _annotated(spark, d).where(filters.score_at_least(F.col("functional"))).select("chrom", "pos", "cadd_scaled")


@query("flt_6_nonsense", "variants", "SELECT chrom, pos, so_term FROM variants WHERE biotype = 'protein_coding' AND so_term IN ('stop_gained', 'frameshift_variant')")
def flt_6(spark: SparkSession, d: str) -> DataFrame:
    return A.variants(spark, d).where(filters.nonsense(F.col("so_term"), F.col("biotype"))).select("chrom", "pos", "so_term")


@query("flt_7_impact", "variants", "SELECT so_term, so_term IN ('stop_gained', 'frameshift_variant') AS high, so_term IN ('missense_variant', 'inframe_deletion') AS moderate, count(*) AS n FROM variants GROUP BY 1")
def flt_7(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("so_term")
    return A.variants(spark, d).groupBy("so_term").agg(F.count("*").alias("n")).select("so_term", filters.is_high(t).alias("high"), filters.is_moderate(t).alias("moderate"), "n")


@query("flt_8_registered_filter", "variants", "SELECT chrom, pos FROM variants WHERE pos % 11 = 0")
def flt_8(spark: SparkSession, d: str) -> DataFrame:
    filters.register_filter("every eleventh", F.col("pos") % 11 == 0)
    return VariantQuery(A.variants(spark, d)).named("every eleventh").select("chrom", "pos").frame()


ATTRITION = f" SELECT CASE WHEN NOT coalesce(opr >= CAST(0.4 AS FLOAT), false) THEN 'OPR' WHEN NOT coalesce(maf < CAST(0.2 AS FLOAT), false) THEN 'CTL-FREQ' WHEN biotype <> 'protein_coding' THEN 'protein_coding' WHEN so_term NOT IN ('stop_gained', 'frameshift_variant') THEN 'high' ELSE 'passed' END AS first_failed, count(*) AS n FROM variants v LEFT JOIN m ON m.chrom = v.chrom AND m.pos = v.pos AND {CONTROL} GROUP BY 1"


def _chain() -> list[tuple[str, F.Column]]:
    return [("OPR", F.col("opr") >= _f(0.4)), ("CTL-FREQ", F.col("maf") < _f(0.2)), ("protein_coding", F.col("biotype") == "protein_coding"), ("high", filters.is_high(F.col("so_term")))]


@query("flt_9_attrition", "calls cohorts variants", STATS + ATTRITION)
def flt_9(spark: SparkSession, d: str) -> DataFrame:
    return filters.attrition(_with_control(spark, d), _chain())


@query("flt_9_transcripts", "calls cohorts variants", STATS + f" SELECT DISTINCT gene, transcript FROM variants v JOIN m ON m.chrom = v.chrom AND m.pos = v.pos AND {CONTROL} WHERE opr >= CAST(0.4 AS FLOAT) AND maf < CAST(0.2 AS FLOAT) AND biotype = 'protein_coding' AND so_term IN ('stop_gained', 'frameshift_variant')")
def flt_9b(spark: SparkSession, d: str) -> DataFrame:
    v = _with_control(spark, d)
    return filters.transcripts(filters.survivors(v, _chain()), filters.nonsense(F.col("so_term"), F.col("biotype")))


@query("flt_10_analysis_chain", "variants", "SELECT CASE WHEN biotype <> 'protein_coding' THEN 'protein_coding' WHEN pos % 100 >= 50 THEN 'ExAC-ALL' WHEN pos % 50 >= 40 THEN 'GNOMAD_GENOMES' WHEN so_term NOT IN ('stop_gained', 'frameshift_variant', 'missense_variant', 'inframe_deletion') THEN 'highOrModerate' ELSE 'passed' END AS first_failed, count(*) AS n FROM (SELECT *, pos % 50 p FROM variants) GROUP BY 1")
def flt_10(spark: SparkSession, d: str) -> DataFrame:
    a = _annotated(spark, d)
    a = a.withColumn("populations", F.transform("populations", lambda x: F.struct(x["study"], x["population"], F.when(x["study"] == "EXAC", x["af"]).otherwise(x["af"] * 1.25 + 0.0).alias("af"))))
    chain = filters.analysis_chain("combined", oprs=F.array(F.lit(1.0)), maf=F.lit(0.0), chrom=F.col("chrom"), biotypes=F.array("biotype"), populations=F.col("populations"), terms=F.array("so_term"), pop_af=0.05)
    return filters.attrition(a, chain)


@query("flt_10_combined_consequence", "variants", "SELECT chrom, pos FROM variants WHERE biotype = 'protein_coding' AND (so_term IN ('stop_gained', 'frameshift_variant') OR cadd_scaled >= 15 AND so_term IN ('missense_variant', 'inframe_deletion') AND pos % 6 <> 0)")
def flt_10b(spark: SparkSession, d: str) -> DataFrame:
    a = _annotated(spark, d)
    return a.where(filters.combined(F.col("so_term"), F.col("biotype"), F.col("cadd_scaled"), filters.benign(F.col("scores")))).select("chrom", "pos")


@query("flt_13_types", "records", "SELECT typ AS type, count(*) AS n FROM records WHERE typ <> 'NO_VARIATION' GROUP BY 1")
def flt_13(spark: SparkSession, d: str) -> DataFrame:
    return A.records(spark, d).where(filters.type_filter(F.col("type"), exclude=("NO_VARIATION",))).groupBy("type").agg(F.count("*").alias("n"))


@query("flt_15_conjunction", "variants", "SELECT chrom, pos FROM variants WHERE biotype = 'protein_coding' AND cadd_scaled >= 15")
def flt_15(spark: SparkSession, d: str) -> DataFrame:
    """Filters that aren't set are passed over."""
    return A.variants(spark, d).where(filters.all_of(F.col("biotype") == "protein_coding", None, F.col("cadd_scaled") >= 15)).select("chrom", "pos")


@query("flt_16_missense_share", "variants", "SELECT count(*) FILTER (WHERE so_term = 'missense_variant') AS missense, count(*) AS total FROM variants")
def flt_16(spark: SparkSession, d: str) -> DataFrame:
    return burden.missense_share(A.variants(spark, d), F.col("so_term"))


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """The calls as a long count table."""
    g = F.col("gt")
    entry = lambda when, slot, allele: F.when(when, F.struct(F.lit(slot).alias("slot"), F.lit(allele).alias("allele")))
    every = F.array(entry(g == "0/1", "V", 1), entry(g == "1/1", "V", 2), entry(g.isin("0/1", "0"), "R", 1), entry(g == "./.", "R", -1))
    return A.calls(spark, d).select("chrom", "pos", "sample_id", F.explode(F.filter(every, lambda x: x.isNotNull())).alias("x")).select("chrom", "pos", "x.slot", "x.allele", "sample_id")


GENOTYPE = {"het": ("0/1",), "hom_alt": ("1/1",), "no_call": ("./.",), "hom_ref": ("0/0",), "not_het": ("!0/1",), "het_or_hom": ("0/1", "1/1")}
GENOTYPE_SQL = {"het": "gt = '0/1'", "hom_alt": "gt = '1/1'", "no_call": "gt = './.'", "hom_ref": "gt IS NULL OR gt = '0/0'", "not_het": "gt IS NULL OR gt <> '0/1'", "het_or_hom": "gt IN ('0/1', '1/1')"}
for _name, _gts in GENOTYPE.items():

    @query(f"flt_20_genotype_{_name}", "calls", f"SELECT p.chrom, p.pos FROM (SELECT DISTINCT chrom, pos FROM calls) p LEFT JOIN calls c ON c.chrom = p.chrom AND c.pos = p.pos AND c.sample_id = 7 WHERE {GENOTYPE_SQL[_name]}")
    def _flt_20(spark: SparkSession, d: str, gts: tuple[str, ...] = _gts) -> DataFrame:
        every = A.calls(spark, d).select("chrom", "pos").distinct()
        return filters.with_genotypes(every, _entries(spark, d), {7: gts}, ["chrom", "pos"])


@query("flt_20_alleles_and_cohort", "variants calls cohorts", STATS + f" SELECT v.chrom, v.pos FROM variants v JOIN m ON m.chrom = v.chrom AND m.pos = v.pos AND {CONTROL} WHERE ref IN ('A') AND alt IN ('C', 'G')")
def flt_20(spark: SparkSession, d: str) -> DataFrame:
    t = _with_control(spark, d).withColumn("ctl_opr", F.col("opr"))
    return VariantQuery(t).reference("A").alternate("C", "G").cohort("ctl").select("chrom", "pos").frame()


BURDEN = f"""
, v AS (SELECT DISTINCT x.chrom, x.pos, gene, transcript FROM variants x JOIN m ON m.chrom = x.chrom AND m.pos = x.pos AND {CONTROL} WHERE opr >= CAST(0.4 AS FLOAT) AND maf < CAST(0.2 AS FLOAT) AND biotype = 'protein_coding' AND so_term IN ('stop_gained', 'frameshift_variant')),
a AS (SELECT chrom, pos, sample_id FROM calls WHERE gt IN ('0/1', '1/1')),
k AS (SELECT sample_id FROM cohorts WHERE cohort = 'ASIA'), c AS (SELECT sample_id FROM cohorts WHERE cohort = 'MIDDLE EAST')"""


def _burden(spark: SparkSession, d: str) -> DataFrame:
    kept = filters.survivors(_with_control(spark, d), _chain()).select("chrom", "pos", "gene", "transcript")
    affected = A.calls(spark, d).where(F.col("gt").isin("0/1", "1/1")).select("chrom", "pos", "sample_id")
    members = A.cohorts(spark, d)
    return burden.gene_burden(kept, affected, members.where("cohort = 'ASIA'"), members.where("cohort = 'MIDDLE EAST'"), ["chrom", "pos"])


@query("agg_gene_burden", "calls cohorts variants", STATS + BURDEN + " SELECT transcript, max(gene) AS gene, CAST(count(DISTINCT k.sample_id) AS INT) AS n_cases, CAST(count(DISTINCT c.sample_id) AS INT) AS n_controls FROM v LEFT JOIN a USING (chrom, pos) LEFT JOIN k ON k.sample_id = a.sample_id LEFT JOIN c ON c.sample_id = a.sample_id GROUP BY transcript")
def agg_7(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: rare, well-covered, protein-truncating variants of cases and controls per transcript."""
    return burden.sizes(_burden(spark, d))


@query("agg_7_burden_lists", "calls cohorts variants", STATS + BURDEN + " SELECT transcript, coalesce(string_agg(DISTINCT CAST(k.sample_id AS VARCHAR), ',' ORDER BY CAST(k.sample_id AS VARCHAR)), '') AS cases FROM v LEFT JOIN a USING (chrom, pos) LEFT JOIN k ON k.sample_id = a.sample_id GROUP BY transcript")
def agg_7b(spark: SparkSession, d: str) -> DataFrame:
    return _burden(spark, d).select("transcript", F.array_join(F.array_sort(F.transform("cases", lambda x: x.cast("string"))), ",").alias("cases"))


@query("agg_7_merged_runs", "calls cohorts variants", STATS + BURDEN + " SELECT transcript, CAST(count(DISTINCT k.sample_id) AS INT) AS n_cases FROM v LEFT JOIN a USING (chrom, pos) LEFT JOIN k ON k.sample_id = a.sample_id GROUP BY transcript")
def agg_7c(spark: SparkSession, d: str) -> DataFrame:
    """A summary united with itself is itself."""
    s = _burden(spark, d)
    return burden.merge_summaries(s, s).select("transcript", F.size("cases").alias("n_cases"))


@query("agg_8_gene_samples", "calls cohorts variants", "SELECT gene, cohort, count(DISTINCT sample_id) AS n FROM variants JOIN calls USING (chrom, pos) JOIN cohorts USING (sample_id) WHERE gt IN ('0/1', '1/1') AND so_term = 'stop_gained' GROUP BY 1, 2")
def agg_8(spark: SparkSession, d: str) -> DataFrame:
    affected = A.calls(spark, d).where(F.col("gt").isin("0/1", "1/1")).select("chrom", "pos", "sample_id")
    found = burden.gene_samples(A.variants(spark, d).where("so_term = 'stop_gained'"), affected, ["chrom", "pos"])
    return burden.by_cohort(found, A.cohorts(spark, d))


@query("agg_11_counters", "calls cohorts variants", STATS + f" SELECT 'variants' AS counter, count(*) AS n FROM variants UNION ALL SELECT 'without frequency', count(*) FILTER (WHERE maf IS NULL) FROM variants v LEFT JOIN m ON m.chrom = v.chrom AND m.pos = v.pos AND {CONTROL} UNION ALL SELECT 'protein coding', count(*) FILTER (WHERE biotype = 'protein_coding') FROM variants UNION ALL SELECT 'passed', count(*) FROM variants v JOIN m ON m.chrom = v.chrom AND m.pos = v.pos AND {CONTROL} WHERE opr >= CAST(0.4 AS FLOAT) AND maf < CAST(0.2 AS FLOAT) AND biotype = 'protein_coding' AND so_term IN ('stop_gained', 'frameshift_variant')")
def agg_11(spark: SparkSession, d: str) -> DataFrame:
    """Counters of a run, observed while its rows are counted: no second pass."""
    seen, passed = Observation(), Observation()
    n = lambda when: F.count_if(F.coalesce(when, F.lit(False)))
    rows = _with_control(spark, d).observe(seen, F.count(F.lit(1)).alias("variants"), n(F.col("maf").isNull()).alias("without frequency"), n(F.col("biotype") == "protein_coding").alias("protein coding"))
    filters.survivors(rows, _chain()).observe(passed, F.count(F.lit(1)).alias("passed")).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list((seen.get | passed.get).items()), "counter string, n long")


SHOWN = r"regexp_replace(regexp_replace(printf('%.3f', round_even(CAST({x} AS DOUBLE), 3)), '(\.[0-9]*?)0+$', '\1'), '\.$', '')"


@query("snk_9_info_fields", "calls cohorts", STATS + " SELECT chrom, pos, string_agg(cohort || '_OPR=' || " + SHOWN.format(x="opr") + " || ';' || cohort || '_CR=' || " + SHOWN.format(x="cr") + " || ';' || cohort || '_PR=' || " + SHOWN.format(x="pr") + ", ';' ORDER BY cohort) AS info FROM m GROUP BY 1, 2")
def snk_9(spark: SparkSession, d: str) -> DataFrame:
    """The INFO text of each variant: three rates for each cohort."""
    return sinks.info_field(_stats(spark, d), ["chrom", "pos"])


@query("gen_5_call_rates", "calls", "SELECT chrom, pos, count(*) FILTER (WHERE pass) AS \"PASS\", count(*) FILTER (WHERE gt <> './.') AS \"CALL\", round(CAST(count(*) FILTER (WHERE gt <> './.') AS DOUBLE) / count(*) * (CAST(count(*) FILTER (WHERE pass) AS DOUBLE) / count(*)), 9) AS \"OPR\" FROM calls GROUP BY 1, 2")
def gen_5(spark: SparkSession, d: str) -> DataFrame:
    from cohortspark.operators.genotypes import call_rates

    g = A.calls(spark, d).groupBy("chrom", "pos").agg(F.count("*").alias("n"), F.count_if(F.col("gt") == "./.").alias("nc"), F.count_if(~F.col("pass")).alias("np"))
    r = call_rates(F.col("n"), F.col("nc"), F.col("np"))
    return g.select("chrom", "pos", r["PASS"].alias("PASS"), r["CALL"].alias("CALL"), F.round(r["OPR"], 9).alias("OPR"))
