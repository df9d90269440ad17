"""Queries of the merge: region rows to variants, genotypes and cohort statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.operators import genotypes as GT
from cohortspark.operators import merge as M
from cohortspark.operators import regions as R
from cohortspark.operators import stats, summaries
from cohortspark.plans.engine import Engine
from cohortspark.sources import adapters as A
from cohortspark.sources import sinks, vcf

from .query import VariantQuery
from .queries_scan import scratch
from .registry import query
from .session import tune

#: Region rows of the records: their alleles, and the base that a second alternate implies.
REGIONS = """
, al AS (SELECT *, unnest(CASE gt WHEN './.' THEN [-1] WHEN '0/0' THEN [0] WHEN '1/2' THEN [1, 2] WHEN '0/2' THEN [0, 2] WHEN '1/1' THEN [1] WHEN '1' THEN [1] ELSE [0, 1] END) AS allele FROM records),
reg AS (SELECT sample_id, chrom, rstart s, CASE WHEN allele = 2 THEN rstart + 1 ELSE rend END e, CASE WHEN allele < 0 THEN 'NOCALL' WHEN allele = 0 THEN 'REF' ELSE 'VAR' END kind,
    CASE WHEN allele = 2 THEN 'AC' WHEN allele = 1 THEN ref END ref, CASE WHEN allele = 2 THEN '' WHEN allele = 1 THEN alt END alt,
    CASE WHEN allele = 2 THEN 'DELETION' WHEN typ = 'INDEL' THEN CASE WHEN rstart > rend THEN 'INSERTION' ELSE 'DELETION' END ELSE typ END typ,
    CASE WHEN gt IN ('0/0', '1/1') THEN 2 ELSE 1 END cnt, coalesce(filt = 'PASS', false) pass FROM al
  UNION ALL SELECT sample_id, chrom, rstart + 1, rstart + 1, 'REF', NULL, NULL, 'DELETION', CASE WHEN gt = '0/2' THEN 2 ELSE 1 END, coalesce(filt = 'PASS', false) FROM records WHERE k = 5 AND gt <> './.'),
own AS (SELECT chrom, s pos, ref, alt, sample_id, sum(cnt) a FROM reg WHERE kind = 'VAR' GROUP BY ALL),
vars AS (SELECT DISTINCT chrom, pos, ref, alt FROM own)""".lstrip()

STATE = """,
state AS (SELECT p.chrom, p.pos, r.sample_id,
    coalesce(sum(cnt) FILTER (WHERE kind = 'REF' AND typ <> 'INSERTION' AND cnt <> 2), 0) r, sum(cnt) FILTER (WHERE kind = 'REF' AND typ = 'INSERTION') ri, bool_or(kind = 'NOCALL') nc,
    coalesce(sum(cnt) FILTER (WHERE kind = 'VAR' AND typ = 'SNV' AND alt = 'A'), 0) ba, coalesce(sum(cnt) FILTER (WHERE kind = 'VAR' AND typ = 'SNV' AND alt = 'C'), 0) bc,
    coalesce(sum(cnt) FILTER (WHERE kind = 'VAR' AND typ = 'SNV' AND alt = 'T'), 0) bt, coalesce(sum(cnt) FILTER (WHERE kind = 'VAR' AND typ = 'SNV' AND alt = 'G'), 0) bg,
    coalesce(sum(cnt) FILTER (WHERE kind = 'VAR' AND typ = 'DELETION'), 0) d, coalesce(sum(cnt) FILTER (WHERE kind = 'VAR' AND typ = 'INSERTION'), 0) n, bool_or(NOT pass) np
  FROM (SELECT DISTINCT chrom, pos FROM vars) p JOIN reg r ON r.chrom = p.chrom AND r.s <= p.pos AND p.pos <= greatest(r.s, r.e) GROUP BY 1, 2, 3),
cov AS (SELECT v.chrom, v.pos, v.ref, v.alt, r.sample_id, sum(cnt) o FROM vars v JOIN reg r ON r.chrom = v.chrom AND r.s <= v.pos AND v.pos <= greatest(r.s, r.e) AND r.kind = 'VAR' AND r.typ <> 'SNV'
  WHERE NOT (length(v.ref) = 1 AND length(v.alt) = 1) AND CASE WHEN length(v.ref) = 0 THEN r.e = v.pos - 1 ELSE r.e >= v.pos + length(v.ref) - 1 END GROUP BY ALL),
x AS (SELECT v.*, t.* EXCLUDE (chrom, pos), coalesce(a, 0) a, coalesce(o, 0) o, CASE WHEN length(v.ref) = length(v.alt) THEN 'SNV' WHEN length(v.ref) = 0 THEN 'INSERTION' ELSE 'DELETION' END typ
  FROM vars v JOIN state t USING (chrom, pos) LEFT JOIN own USING (chrom, pos, ref, alt, sample_id) LEFT JOIN cov USING (chrom, pos, ref, alt, sample_id)),
y AS (SELECT *, greatest(o - a, 0) more, CASE WHEN o = 0 THEN d ELSE 0 END + ba + bc + bt + bg base FROM x),
i1 AS (SELECT *, CASE WHEN ba > 0 AND (a = 0 AND n = 0 OR ri IS NULL) THEN coalesce(ri, 0) + ba ELSE ri END k1 FROM y),
i2 AS (SELECT *, CASE WHEN bc > 0 AND (a = 0 AND n = 0 OR k1 IS NULL) THEN coalesce(k1, 0) + bc ELSE k1 END k2 FROM i1),
i3 AS (SELECT *, CASE WHEN bt > 0 AND (a = 0 AND n = 0 OR k2 IS NULL) THEN coalesce(k2, 0) + bt ELSE k2 END k3 FROM i2),
i4 AS (SELECT *, CASE WHEN bg > 0 AND (a = 0 AND n = 0 OR k3 IS NULL) THEN coalesce(k3, 0) + bg ELSE k3 END k4 FROM i3),
i5 AS (SELECT *, CASE WHEN k4 IS NULL AND nc THEN -1 ELSE k4 END k5 FROM i4),
z AS (SELECT *, CASE typ WHEN 'SNV' THEN CASE WHEN r > 0 THEN r WHEN nc THEN -1 END
    WHEN 'INSERTION' THEN CASE WHEN r > 0 THEN CASE WHEN k5 IS NULL THEN r WHEN a = 0 AND more = 0 THEN CASE WHEN k5 = -1 THEN r ELSE k5 + r END ELSE k5 END ELSE k5 END
    ELSE CASE WHEN base + r + CASE WHEN n > 0 AND r = 0 AND (a > 0 AND base = 0 OR a = 0 AND d > 0) THEN n ELSE 0 END > 0
      THEN base + r + CASE WHEN n > 0 AND r = 0 AND (a > 0 AND base = 0 OR a = 0 AND d > 0) THEN n ELSE 0 END WHEN nc THEN -1 END END reference FROM i5),
mg AS (SELECT chrom, pos, ref, alt, typ, sample_id, a, CASE WHEN reference <> 2 THEN reference END reference, np,
    CASE WHEN typ = 'SNV' AND alt <> 'A' AND ba > 0 THEN ba END sa, CASE WHEN typ = 'SNV' AND alt <> 'C' AND bc > 0 THEN bc END sc, CASE WHEN typ = 'SNV' AND alt <> 'T' AND bt > 0 THEN bt END st, CASE WHEN typ = 'SNV' AND alt <> 'G' AND bg > 0 THEN bg END sg,
    CASE WHEN typ IN ('SNV', 'INSERTION') THEN CASE WHEN d > 0 THEN d END WHEN more > 0 THEN more END sd, CASE typ WHEN 'SNV' THEN CASE WHEN n > 0 THEN n END WHEN 'INSERTION' THEN CASE WHEN more > 0 THEN more END END si FROM z),
merged AS (SELECT * FROM mg WHERE a > 0 OR np OR coalesce(reference, sa, sc, st, sg, sd, si) IS NOT NULL)"""

SLOT_SQL = """,
slots AS (SELECT chrom, pos, ref, alt, sample_id, unnest(['R', 'V', 'A', 'C', 'T', 'G', '*', '+', 'F']) slot, unnest([reference, CASE WHEN a > 0 THEN a END, sa, sc, st, sg, sd, si, CASE WHEN np THEN 0 END]) allele FROM merged)"""


def _regions(spark: SparkSession, d: str) -> DataFrame:
    return R.call_regions(A.records(spark, d))


#: Region rows that a task of the merge is given: at the tables' density some 5 million counts would spill, these don't.
TASK_ROWS = 250_000


def _merged(spark: SparkSession, d: str) -> DataFrame:
    """The merge of a written region table, in partitions that follow the table's size."""
    rows = _stored(tune(spark), _regions(spark, d))
    parts = rows.count() // TASK_ROWS
    return M.merge(rows, width=8, keep_bin=True, parts=parts if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else None)


def _stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows written once, for queries that read them more than once: a plan's parts would each make them anew."""
    path = scratch(spark, "stored")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@query("cmb_1_variant_map", "records", REGIONS + " SELECT chrom, pos, ref, alt, CAST(a AS INT) AS a, count(*) AS n FROM own GROUP BY ALL")
def cmb_1(spark: SparkSession, d: str) -> DataFrame:
    return M.variant_samples(_regions(spark, d)).groupBy(*M.VARIANT, "a").agg(F.count("*").alias("n"))


@query("cmb_2_position_state", "records", REGIONS + STATE + " SELECT chrom, pos, sample_id, CAST(r AS INT) AS r, CAST(coalesce(ri, -9) AS INT) AS ri, nc, CAST(ba AS INT) AS b_a, CAST(bg AS INT) AS b_g, CAST(d AS INT) AS d, CAST(n AS INT) AS n, np FROM state")
def cmb_2(spark: SparkSession, d: str) -> DataFrame:
    rows = _regions(spark, d)
    points = M.variant_samples(rows).select(*M.POINT).distinct()
    s = M.position_states(points, rows, 8)
    return s.select("chrom", "pos", "sample_id", "r", F.coalesce("ri", F.lit(-9)).alias("ri"), "nc", F.col("b_A").alias("b_a"), F.col("b_G").alias("b_g"), "d", "n", F.col("not_pass").alias("np"))


@query("cmb_3_repeated_entries", "records", REGIONS + " SELECT chrom, s AS pos, ref, alt, CAST(sum(cnt) AS BIGINT) AS total FROM (SELECT * FROM reg UNION ALL SELECT * FROM reg) WHERE kind = 'VAR' GROUP BY ALL")
def cmb_3(spark: SparkSession, d: str) -> DataFrame:
    """A load that came twice doubles each sample's count."""
    rows = _regions(spark, d)
    return M.variant_samples(M.append_counts(rows, rows)).groupBy(*M.VARIANT).agg(F.sum("a").alias("total"))


@query("cmb_4_pass_sets", "records", REGIONS + STATE + " SELECT chrom, pos, count(*) FILTER (WHERE np) AS failed, count(*) FILTER (WHERE NOT np) AS passed FROM state GROUP BY 1, 2")
def cmb_4(spark: SparkSession, d: str) -> DataFrame:
    rows = _regions(spark, d)
    s = M.position_states(M.variant_samples(rows).select(*M.POINT).distinct(), rows, 8)
    return s.groupBy("chrom", "pos").agg(F.count_if("not_pass").alias("failed"), F.count_if(~F.col("not_pass")).alias("passed"))


@query("cmb_5_overlap_index", "records", REGIONS + " SELECT chrom, CAST(pos + length(ref) - 1 AS INT) AS \"end\", sample_id, CAST(sum(a) AS BIGINT) AS total FROM own WHERE NOT (length(ref) = 1 AND length(alt) = 1) GROUP BY ALL")
def cmb_5(spark: SparkSession, d: str) -> DataFrame:
    own = M.variant_samples(_regions(spark, d)).where("NOT (length(ref) = 1 AND length(alt) = 1)")
    return own.groupBy("chrom", F.expr("pos + length(ref) - 1").alias("end"), "sample_id").agg(F.sum("a").alias("total"))


@query("cmb_6_join_4_covering", "records", REGIONS + STATE + " SELECT chrom, pos, ref, alt, sample_id, CAST(o AS INT) AS o FROM cov")
def cmb_6(spark: SparkSession, d: str) -> DataFrame:
    rows = _regions(spark, d)
    return M.covering(M.variant_samples(rows).select(*M.VARIANT).distinct(), rows, 8)


def _combined(kind: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        z = lambda c: F.coalesce(c, F.lit(0)).alias(c)
        return _merged(spark, d).where(F.col("type") == kind).select(*M.VARIANT, "sample_id", "a", z("reference"), z("sec_A"), z("sec_C"), z("sec_T"), z("sec_G"), z("sec_del"), z("sec_ins"), F.col("not_pass"))

    return run


for _name, _kind in (("cmb_7_8_11_snv", "SNV"), ("cmb_9_deletion", "DELETION"), ("cmb_10_insertion", "INSERTION")):
    query(_name, "records", REGIONS + STATE + f" SELECT chrom, pos, ref, alt, sample_id, CAST(a AS INT) AS a, CAST(coalesce(reference, 0) AS INT) AS reference, CAST(coalesce(sa, 0) AS INT) AS \"sec_A\", CAST(coalesce(sc, 0) AS INT) AS \"sec_C\", CAST(coalesce(st, 0) AS INT) AS \"sec_T\", CAST(coalesce(sg, 0) AS INT) AS \"sec_G\", CAST(coalesce(sd, 0) AS INT) AS sec_del, CAST(coalesce(si, 0) AS INT) AS sec_ins, np AS not_pass FROM merged WHERE typ = '{_kind}'")(_combined(_kind))


@query("cmb_12_not_pass_indexed", "records", REGIONS + STATE + " SELECT chrom, pos, ref, alt, count(*) FILTER (WHERE np AND sample_id % 2 = 0) AS n FROM x GROUP BY ALL HAVING n > 0")
def cmb_12(spark: SparkSession, d: str) -> DataFrame:
    rows = _regions(spark, d)
    indexed = rows.where("sample_id % 2 = 0").select("sample_id").distinct()
    return M.merge(rows, indexed, 8).where("not_pass").groupBy(*M.VARIANT).agg(F.count("*").alias("n"))


@query("cmb_13_other_overlaps", "records", REGIONS + STATE + " SELECT chrom, pos, ref, alt, CAST(sum(greatest(o - a, 0)) AS BIGINT) AS more FROM x WHERE typ = 'DELETION' GROUP BY ALL")
def cmb_13(spark: SparkSession, d: str) -> DataFrame:
    rows = _regions(spark, d)
    own = M.variant_samples(rows).where("length(ref) > 0 AND length(alt) = 0")
    over = M.covering(own.select(*M.VARIANT).distinct(), rows, 8).join(own, [*M.VARIANT, "sample_id"], "left")
    return over.groupBy(*M.VARIANT).agg(F.sum(F.greatest(F.col("o") - F.coalesce("a", F.lit(0)), F.lit(0))).alias("more"))


@query("cmb_14_pivoted_lists", "records", REGIONS + " SELECT chrom, pos, ref, alt, CAST(a AS INT) AS allele, string_agg(CAST(sample_id AS VARCHAR), ',' ORDER BY sample_id) AS ids FROM own GROUP BY ALL")
def cmb_14(spark: SparkSession, d: str) -> DataFrame:
    v = M.variant_samples(_regions(spark, d)).select(*M.VARIANT, F.lit("V").alias("slot"), F.col("a").alias("allele"), "sample_id")
    return M.sample_lists(v).select(*M.VARIANT, "allele", F.array_join(F.transform("sample_ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("cmb_15_18_merge_pipeline", "records", REGIONS + STATE + SLOT_SQL + " SELECT chrom, pos, ref, alt, slot, CAST(allele AS INT) AS allele, sample_id FROM slots WHERE allele IS NOT NULL")
def cmb_15(spark: SparkSession, d: str) -> DataFrame:
    return M.slots(_merged(spark, d))


@query("cmb_16_17_incremental_load", "records", REGIONS + STATE + SLOT_SQL + " SELECT slot, CAST(allele AS INT) AS allele, count(*) AS n FROM slots WHERE allele IS NOT NULL GROUP BY ALL")
def cmb_16(spark: SparkSession, d: str) -> DataFrame:
    """Two batches of files loaded one after the other give what one load of all gives (also SNK-17/18)."""
    engine = Engine(spark, scratch(spark, "study"), 512)
    calls = A.records(spark, d)
    engine.load(calls, "first", [0, 1, 2, 3, 4])
    engine.load(calls, "second", [5, 6, 7, 8, 9])
    engine.load(calls, "second", [5, 6, 7, 8, 9])
    return engine.counts().groupBy("slot", "allele").agg(F.count("*").alias("n"))


@query("cmb_19_sample_filter", "records", REGIONS + " SELECT chrom, pos, ref, alt, count(*) AS n FROM own WHERE sample_id % 5 = 0 GROUP BY ALL")
def cmb_19(spark: SparkSession, d: str) -> DataFrame:
    own = M.variant_samples(_regions(spark, d))
    chosen = own.where("sample_id % 5 = 0").select("sample_id").distinct()
    return own.join(chosen, "sample_id", "left_semi").groupBy(*M.VARIANT).agg(F.count("*").alias("n"))


GT_SQL = """,
used AS (SELECT chrom, pos, ref, alt, bool_or(sa > 0) ua, bool_or(sc > 0) uc, bool_or(st > 0) ut, bool_or(sg > 0) ug, bool_or(sd > 0) ud, bool_or(si > 0 AND typ = 'INSERTION') ui FROM merged GROUP BY ALL),
num AS (SELECT chrom, pos, ref, alt, 2 ia, 2 + coalesce(ua, false)::INT ic, 2 + coalesce(ua, false)::INT + coalesce(uc, false)::INT it, 2 + coalesce(ua, false)::INT + coalesce(uc, false)::INT + coalesce(ut, false)::INT ig,
  2 + coalesce(ua, false)::INT + coalesce(uc, false)::INT + coalesce(ut, false)::INT + coalesce(ug, false)::INT id, 2 + coalesce(ua, false)::INT + coalesce(uc, false)::INT + coalesce(ut, false)::INT + coalesce(ug, false)::INT + coalesce(ud, false)::INT ii FROM used),
gts AS (SELECT m.*, CASE WHEN typ = 'INSERTION' THEN coalesce(si, 0) ELSE 0 END si2,
  array_to_string(list_sort(list_concat(list_concat(list_concat([CAST('0' AS VARCHAR) FOR q IN range(CAST(greatest(coalesce(reference, 0), 0) AS BIGINT))], [CAST('1' AS VARCHAR) FOR q IN range(CAST(a AS BIGINT))]), list_concat([CAST(ia AS VARCHAR) FOR q IN range(CAST(coalesce(sa, 0) AS BIGINT))], [CAST(ic AS VARCHAR) FOR q IN range(CAST(coalesce(sc, 0) AS BIGINT))])),
    list_concat(list_concat([CAST(it AS VARCHAR) FOR q IN range(CAST(coalesce(st, 0) AS BIGINT))], [CAST(ig AS VARCHAR) FOR q IN range(CAST(coalesce(sg, 0) AS BIGINT))]), list_concat([CAST(id AS VARCHAR) FOR q IN range(CAST(coalesce(sd, 0) AS BIGINT))], [CAST(ii AS VARCHAR) FOR q IN range(CAST(CASE WHEN typ = 'INSERTION' THEN coalesce(si, 0) ELSE 0 END AS BIGINT))])))), '/') j
  FROM merged m JOIN num USING (chrom, pos, ref, alt)),
gt AS (SELECT *, CASE WHEN coalesce(sa, sc, st, sg, sd) IS NULL AND si2 = 0 AND a = 2 AND reference IS NULL THEN '1/1' WHEN coalesce(sa, sc, st, sg, sd) IS NULL AND si2 = 0 AND a = 1 AND reference = 1 THEN '0/1'
  WHEN coalesce(sa, sc, st, sg, sd) IS NULL AND si2 = 0 AND a = 0 AND reference = -1 THEN '.' WHEN j = '' THEN '0/0' ELSE j END gt2 FROM gts)"""


@query("gen_1_3_genotypes", "records", REGIONS + STATE + GT_SQL + " SELECT chrom, pos, ref, alt, sample_id, gt2 AS gt FROM gt")
def gen_1(spark: SparkSession, d: str) -> DataFrame:
    return GT.sample_genotypes(_merged(spark, d)).select(*M.VARIANT, "sample_id", "gt")


@query("gen_2_genotype_strings", "records", REGIONS + STATE + GT_SQL + " SELECT gt2 AS gt, count(*) AS n FROM gt GROUP BY 1")
def gen_2(spark: SparkSession, d: str) -> DataFrame:
    return GT.sample_genotypes(_merged(spark, d)).groupBy("gt").agg(F.count("*").alias("n"))


@query("gen_4_allele_lists", "records", REGIONS + STATE + GT_SQL + " SELECT chrom, pos, ref, alt, ref || ',' || alt || CASE WHEN ua THEN ',A' ELSE '' END || CASE WHEN uc THEN ',C' ELSE '' END || CASE WHEN ut THEN ',T' ELSE '' END || CASE WHEN ug THEN ',G' ELSE '' END || CASE WHEN ud THEN ',*' ELSE '' END || CASE WHEN ui THEN ',*' ELSE '' END AS alleles FROM used")
def gen_4(spark: SparkSession, d: str) -> DataFrame:
    return GT.indexes(GT.used_seconds(_merged(spark, d))).select(*M.VARIANT, F.array_join("alleles", ",").alias("alleles"))


@query("gen_6_reference_entries", "records", REGIONS + STATE + " SELECT CAST(reference AS INT) AS allele, count(*) AS n FROM merged WHERE reference IN (-1, 1) GROUP BY 1")
def gen_6(spark: SparkSession, d: str) -> DataFrame:
    return GT.valid_reference(M.slots(_merged(spark, d))).where("slot = 'R'").groupBy("allele").agg(F.count("*").alias("n"))


@query("gen_7_affected", "records", REGIONS + STATE + GT_SQL + " SELECT chrom, pos, ref, alt, count(*) AS n FROM gt WHERE list_contains(string_split(gt2, '/'), '1') GROUP BY ALL")
def gen_7(spark: SparkSession, d: str) -> DataFrame:
    return GT.affected(GT.sample_genotypes(_merged(spark, d))).groupBy(*M.VARIANT).agg(F.count("*").alias("n"))


@query("gen_1_genotype_classes", "records cohorts", REGIONS + STATE + GT_SQL + """, c AS (SELECT sample_id FROM cohorts WHERE cohort = 'ASIA')
SELECT chrom, pos, ref, alt, (SELECT count(*) FROM c) - count(*) FILTER (WHERE c.sample_id IS NOT NULL AND gt2 <> '0/0') AS hom_ref, count(*) FILTER (WHERE c.sample_id IS NOT NULL AND gt2 = '0/1') AS het, count(*) FILTER (WHERE c.sample_id IS NOT NULL AND gt2 = '1/1') AS hom_alt FROM gt LEFT JOIN c ON c.sample_id = gt.sample_id GROUP BY ALL""")
def gen_1b(spark: SparkSession, d: str) -> DataFrame:
    asia = A.cohorts(spark, d).where("cohort = 'ASIA'").select("sample_id")
    c = GT.genotype_classes(GT.sample_genotypes(_merged(spark, d)), asia)
    n = lambda x: F.coalesce(F.size(x), F.lit(0)).cast("bigint")
    size = lambda x: F.when(F.col(x).isNull(), 0).otherwise(n(x)).cast("bigint").alias(x)
    return c.select(*M.VARIANT, F.col("hom_ref_count").cast("bigint").alias("hom_ref"), size("het"), size("hom_alt"))


COHORT_SQL = """, b AS (SELECT m.*, coalesce(sa, 0) + coalesce(sc, 0) + coalesce(st, 0) + coalesce(sg, 0) + coalesce(sd, 0) + CASE WHEN typ = 'INSERTION' THEN coalesce(si, 0) ELSE 0 END os FROM merged m),
g AS (SELECT chrom, pos, ref, alt, cohort, CAST(sum(a) AS INT) alt_ac, CAST(sum(os) AS INT) other_ac, count(*) FILTER (WHERE reference = 1) r1, count(*) FILTER (WHERE reference = -1 AND a = 0 AND os = 0) nc, count(*) FILTER (WHERE coalesce(reference IN (1), false) OR coalesce(reference = -1, false) AND a = 0 AND os = 0 OR a > 0 OR os > 0) me, count(*) FILTER (WHERE np) np FROM b JOIN cohorts USING (sample_id) GROUP BY ALL),
h AS (SELECT g.*, n, 2 * (n - me) + r1 ref_ac FROM g JOIN (SELECT cohort, count(*) n FROM cohorts GROUP BY 1) USING (cohort))"""


@query("agg_1_merged_statistics", "records cohorts", REGIONS + STATE + COHORT_SQL + " SELECT chrom, pos, ref, alt, cohort, CAST(ref_ac AS INT) AS ref_ac, alt_ac, other_ac, CAST(nc AS INT) AS no_call, CAST(np AS INT) AS not_pass, round(CAST(least(ref_ac, alt_ac) AS DOUBLE) / (ref_ac + alt_ac + other_ac), 5) AS maf FROM h WHERE ref_ac + alt_ac + other_ac > 0")
def agg_1m(spark: SparkSession, d: str) -> DataFrame:
    """Hom-ref samples by subtraction from the cohort's size."""
    s = stats.cohort_statistics(_merged(spark, d), A.cohorts(spark, d))
    return s.where("total_ac > 0").select(*M.VARIANT, "cohort", "ref_ac", "alt_ac", "other_ac", "no_call", "not_pass", F.round(F.col("maf").cast("double"), 5).alias("maf"))


@query("snk_1_slot_table", "records", REGIONS + STATE + SLOT_SQL + " SELECT slot, count(*) AS n, count(DISTINCT sample_id) AS samples FROM slots WHERE allele IS NOT NULL GROUP BY 1")
def snk_1(spark: SparkSession, d: str) -> DataFrame:
    """The count table written by chromosome and read again."""
    path = scratch(spark, "counts")
    rows = M.slots(_merged(spark, d))
    sinks.write_variants(rows, path)
    return spark.read.schema(rows.schema).parquet(path).groupBy("slot").agg(F.count("*").alias("n"), F.countDistinct("sample_id").alias("samples"))


@query("snk_2_region_table", "records", REGIONS + " SELECT kind, count(*) AS n, CAST(sum(cnt) AS BIGINT) AS alleles FROM reg GROUP BY 1")
def snk_2(spark: SparkSession, d: str) -> DataFrame:
    """Region rows appended by chromosome and bin."""
    path = scratch(spark, "regions")
    rows = _regions(spark, d).withColumn("bin", F.floor(F.least("start", "end") / R.BIN).cast("int"))
    for part in (0, 1):
        sinks.write_regions(rows.where(F.col("sample_id") % 2 == part), path)
    return spark.read.parquet(path).groupBy("kind").agg(F.count("*").alias("n"), F.sum("allele_count").alias("alleles"))


@query("snk_4_11_export", "records cohorts", REGIONS + STATE + COHORT_SQL + " SELECT chrom, pos, ref, alt, count(*) AS n_cohorts, CAST(max(n) AS INT) AS largest FROM h GROUP BY ALL")
def snk_4(spark: SparkSession, d: str) -> DataFrame:
    """Export records with the cohort statistics as a map, written and read."""
    path = scratch(spark, "export")
    cohorts = A.cohorts(spark, d)
    every = cohorts.where("cohort = 'ALL'").select("sample_id")
    # gathered in the merge's partitions, which a written table doesn't keep
    told = _stored(spark, summaries.variant_summaries(GT.sample_genotypes(_merged(spark, d)), cohorts, every))
    none = told.select(*M.VARIANT, F.array().cast("array<string>").alias("terms"))
    rows = sinks.export_rows(summaries.classes(told, every), summaries.statistics(told, cohorts), none)
    sinks.write_variants(rows, path)
    return spark.read.schema(rows.schema).parquet(path).where("stats IS NOT NULL").select(*M.VARIANT, F.size("stats").cast("bigint").alias("n_cohorts"), F.array_max(F.transform(F.map_values("stats"), lambda s: s["numSamples"])).alias("largest"))


@query("src_19_flt_20_slot_query", "records", REGIONS + STATE + " SELECT chrom, pos, ref, alt FROM merged WHERE sample_id = 7 AND a = 2")
def flt_20s(spark: SparkSession, d: str) -> DataFrame:
    counts = M.slots(_merged(spark, d))
    return VariantQuery(counts.select(*M.VARIANT).distinct(), counts).genotype({7: ("1/1",)}).select(*M.VARIANT).frame()


#: Samples of a gVCF file.
FILE_SAMPLES = 16


def _vcf_text(spark: SparkSession, d: str, path: str) -> DataFrame:
    """The records as gVCF files, of up to ``FILE_SAMPLES`` samples of a file id each; returns the samples.

    A record's line has a column for each sample of its file, so the bound keeps the text
    in proportion to the records.
    """
    r = A.records(spark, d)
    samples = A.table(spark, d, "supplier").select(F.col("s_suppkey").cast("int").alias("sample_id"), F.concat(F.lit("S"), "s_suppkey").alias("name"))
    dealt = samples.withColumn("file_id", F.expr("sample_id % 10")).withColumn("at", F.row_number().over(W.partitionBy("file_id").orderBy("sample_id")) - 1)
    dealt = dealt.withColumns({"part": F.floor(F.col("at") / FILE_SAMPLES).cast("int"), "nr": F.col("at") % FILE_SAMPLES}).drop("at")
    head = dealt.groupBy("file_id", "part").agg(F.array_sort(F.collect_list(F.struct("nr", "name"))).alias("x"), F.count("*").cast("int").alias("n"))
    header = head.select("file_id", "part", F.explode(F.array(F.struct(F.lit(0).alias("o"), F.lit("##fileformat=VCFv4.2").alias("line")), F.struct(F.lit(1).alias("o"), F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"), F.array_join("x.name", "\t")).alias("line")))).alias("h")).select("file_id", "part", "h.o", "h.line")
    second = F.size("sec_alts") > 0
    ref = F.when(F.col("type") == "NO_VARIATION", "N").otherwise(F.concat(F.lit("N"), F.when(second, "AC").otherwise(F.col("ref"))))
    alt = F.when(F.col("type") == "NO_VARIATION", "<NON_REF>").when(second, F.concat(F.lit("N"), "alt", F.lit("C,N,<NON_REF>"))).otherwise(F.concat(F.lit("N"), "alt"))
    pos = F.when(F.col("type") == "NO_VARIATION", F.col("start")).otherwise(F.col("start") - 1)
    info = F.when(F.col("type") == "NO_VARIATION", F.concat(F.lit("DP=9;END="), "end")).otherwise(".")
    entry = F.concat_ws(":", "gt", F.col("dp").cast("string"), F.array_join(F.col("ad").cast("array<string>"), ","))
    rows = r.join(dealt.select("sample_id", "part", "nr"), "sample_id").join(head.select("file_id", "part", "n"), ["file_id", "part"])
    line = F.concat(F.concat_ws("\t", "chrom", pos.cast("string"), F.lit("."), ref, alt, F.lit("."), F.coalesce("filter", F.lit(".")), info, F.lit("GT:DP:AD")), F.repeat(F.lit("\t."), F.col("nr")), F.lit("\t"), entry, F.repeat(F.lit("\t."), F.col("n") - 1 - F.col("nr")))
    body = rows.select("file_id", "part", F.lit(2).alias("o"), line.alias("line"))
    text = header.unionByName(body).repartition("file_id", "part").sortWithinPartitions("file_id", "part", "o").select("file_id", "part", "line")
    text.write.partitionBy("file_id", "part").option("compression", "gzip").text(path)
    return samples


@query("src_vcf_records", "records", "SELECT sample_id, chrom, rstart AS start, CAST(rend AS INT) AS \"end\", ref, alt, typ AS type, CAST(CASE WHEN k = 5 THEN 1 ELSE 0 END AS INT) AS seconds, gt, dp, CAST(ad[2] AS INT) AS ad1, filt AS filter FROM records")
def src_vcf(spark: SparkSession, d: str) -> DataFrame:
    """Call records through gVCF text and back: reference blocks, padded indels, second alternates, many samples a file."""
    path = scratch(spark, "vcf")
    samples = _vcf_text(spark, d, path)
    rows = vcf.read_vcf(spark, path, samples)
    return rows.select("sample_id", "chrom", "start", "end", "ref", "alt", "type", F.size("sec_alts").alias("seconds"), "gt", "dp", F.get("ad", F.lit(1)).alias("ad1"), "filter")


@query("snk_8_sample_vcf", "records", REGIONS + STATE + GT_SQL + """, s AS (SELECT CAST(s_suppkey AS INT) sample_id FROM supplier), shown AS (SELECT chrom, pos, ref, alt, CASE WHEN ua THEN ',A' ELSE '' END || CASE WHEN uc THEN ',C' ELSE '' END || CASE WHEN ut THEN ',T' ELSE '' END || CASE WHEN ug THEN ',G' ELSE '' END AS bases, CASE WHEN ud THEN ',*' ELSE '' END || CASE WHEN ui THEN ',*' ELSE '' END AS stars FROM used),
v AS (SELECT chrom, pos, ref, alt, string_agg(coalesce(gt2, '0/0'), chr(9) ORDER BY sample_id) AS gts FROM (SELECT DISTINCT chrom, pos, ref, alt FROM gt) CROSS JOIN s LEFT JOIN gt USING (chrom, pos, ref, alt, sample_id) GROUP BY ALL),
p AS (SELECT v.*, bases, stars, length(ref) = 0 OR length(alt) = 0 AS blank FROM v JOIN shown USING (chrom, pos, ref, alt))
SELECT chrom || chr(9) || (CASE WHEN blank THEN pos - 1 ELSE pos END) || chr(9) || '.' || chr(9) || (CASE WHEN blank THEN 'N' ELSE '' END) || ref || chr(9) || (CASE WHEN blank THEN 'N' || alt || replace(bases, ',', ',N') ELSE alt || bases END) || stars || chr(9) || '.' || chr(9) || '.' || chr(9) || '.' || chr(9) || 'GT' || chr(9) || gts AS line FROM p""")
def snk_8s(spark: SparkSession, d: str) -> DataFrame:
    """The merged variants as a multi-sample VCF, written and read as text."""
    path = scratch(spark, "sample-vcf")
    samples = A.table(spark, d, "supplier").select(F.col("s_suppkey").cast("int").alias("sample_id"), F.concat(F.lit("S"), "s_suppkey").alias("name"))
    # most of a line repeats; entries are gathered in the merge's partitions
    entries = _stored(spark, vcf.sample_entries(GT.sample_genotypes(_merged(spark, d)), samples))
    vcf.write_sample_vcf(spark, entries, samples, path, compression="lz4")
    return spark.read.text(f"{path}/body").select(F.col("value").alias("line"))
