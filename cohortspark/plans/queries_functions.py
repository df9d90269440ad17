"""Queries of scalar functions, set operations, orders and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.functions import genotype as G
from cohortspark.functions import keys
from cohortspark.functions.hwe import exact_p
from cohortspark.operators import annotate, filters, qc
from cohortspark.sources import adapters as A
from cohortspark.sources import sinks

from .queries_scan import scratch
from .query import VariantQuery
from .registry import query


@query("gt_1_allele_counts", "calls", """SELECT gt, CASE gt WHEN './.' THEN '-1:1' WHEN '0/1' THEN '0:1,1:1' WHEN '1/1' THEN '1:2' WHEN '0' THEN '0:1' ELSE '0:2' END AS counts, count(*) AS n FROM calls GROUP BY gt""")
def gt_1(spark: SparkSession, d: str) -> DataFrame:
    entries = F.transform(F.map_entries(G.allele_counts(F.col("gt"))), lambda x: F.concat_ws(":", x["key"], x["value"]))
    return A.calls(spark, d).groupBy("gt").agg(F.count("*").alias("n")).select("gt", F.array_join(entries, ",").alias("counts"), "n")


@query("gt_2_depth", "records", "SELECT sample_id, chrom, rstart AS start, CAST(ad[1] AS INT) AS d0, CAST(ad[2] AS INT) AS d1, CAST(dp AS INT) AS d2 FROM records")
def gt_2(spark: SparkSession, d: str) -> DataFrame:
    at = lambda k: G.depth(F.lit(k), F.col("ad"), F.col("dp")).alias(f"d{k}")
    return A.records(spark, d).select("sample_id", "chrom", "start", at(0), at(1), at(2))


@query("gt_14_types", "records", "SELECT ref, alt, CASE k WHEN 0 THEN 'SNV' WHEN 1 THEN 'SNV' WHEN 2 THEN 'DELETION' WHEN 3 THEN 'INSERTION' WHEN 4 THEN 'NO_VARIATION' ELSE 'SNV' END AS type, count(*) AS n FROM records GROUP BY ref, alt, 3")
def gt_14(spark: SparkSession, d: str) -> DataFrame:
    return A.records(spark, d).groupBy("ref", "alt", G.infer_type(F.col("ref"), F.col("alt")).alias("type")).agg(F.count("*").alias("n"))


@query("gt_15_type_of_id", "variants", "SELECT chrom, pos, 'SNV' AS type, pos AS \"end\" FROM variants")
def gt_15(spark: SparkSession, d: str) -> DataFrame:
    v = A.variants(spark, d).withColumn("id", G.parse_id(G.variant_id(F.col("ref"), F.col("alt"))))
    return v.select("chrom", "pos", G.type_of_id(F.col("id.ref"), F.col("id.alt")).alias("type"), G.end_of(F.col("pos"), F.col("id.ref")).alias("end"))


@query("gt_16_variant_ids", "records", "SELECT ref || '_' || alt AS vid, ref, alt, count(*) AS n FROM records GROUP BY ref, alt")
def gt_16(spark: SparkSession, d: str) -> DataFrame:
    r = A.records(spark, d).groupBy(G.variant_id(F.col("ref"), F.col("alt")).alias("vid")).agg(F.count("*").alias("n"))
    return r.withColumn("id", G.parse_id(F.col("vid"))).select("vid", "id.ref", "id.alt", "n")


HWE_SQL = """
, g AS (SELECT chrom, pos, count(*) FILTER (WHERE gt = '1/1') aa0, count(*) FILTER (WHERE gt = '0/1') ab, count(*) FILTER (WHERE gt = '0/0') bb0 FROM calls GROUP BY 1, 2),
m AS (SELECT chrom, pos, least(aa0, bb0) aa, ab, greatest(aa0, bb0) bb, aa0 + ab + bb0 n FROM g),
q AS (SELECT *, 2 * aa + ab rare FROM m WHERE n > 0),
e AS (SELECT q.*, h FROM q, unnest(range(rare % 2, rare + 1, 2)) u(h)),
w AS (SELECT *, h * ln(2) - lgamma((rare - h) // 2 + 1) - lgamma(h + 1) - lgamma(n - h - (rare - h) // 2 + 1) lp FROM e),
z AS (SELECT *, exp(lp - max(lp) OVER (PARTITION BY chrom, pos)) p FROM w),
r AS (SELECT chrom, pos, sum(p) FILTER (WHERE h >= ab) / sum(p) top, sum(p) FILTER (WHERE h <= ab) / sum(p) oth FROM z GROUP BY 1, 2)
SELECT m.chrom, m.pos, round(CASE WHEN m.n < 1 THEN -1 WHEN top > 0.5 AND oth > 0.5 THEN 1.0 ELSE 2 * least(top, oth) END, 6) AS hwe FROM m LEFT JOIN r USING (chrom, pos)""".lstrip()


@query("agg_3_fn_1_hardy_weinberg", "calls", HWE_SQL)
def fn_1(spark: SparkSession, d: str) -> DataFrame:
    n = lambda gt: F.count_if(F.col("gt") == gt)
    g = A.calls(spark, d).groupBy("chrom", "pos").agg(n("1/1").alias("aa"), n("0/1").alias("ab"), n("0/0").alias("bb"))
    once = g.select("aa", "ab", "bb").distinct().withColumn("hwe", F.round(exact_p(F.col("aa"), F.col("ab"), F.col("bb")), 6))
    return g.join(once, ["aa", "ab", "bb"]).select("chrom", "pos", "hwe")


@query("fn_2_strings", "variants", "SELECT upper(gene) AS gene, count(*) AS n, max(split_part(transcript, '.', 2)) AS last_size, repeat(max(ref), 3) AS thrice, min(substr(so_term, 1, 4)) AS lead, count(*) FILTER (WHERE starts_with(so_term, 'stop')) AS stops FROM variants GROUP BY 1")
def fn_2(spark: SparkSession, d: str) -> DataFrame:
    return A.variants(spark, d).groupBy(F.upper("gene").alias("gene")).agg(
        F.count("*").alias("n"), F.max(F.get(F.split("transcript", r"\."), F.lit(1))).alias("last_size"), F.repeat(F.max("ref"), F.lit(3)).alias("thrice"), F.min(F.substring("so_term", 1, 4)).alias("lead"), F.count_if(F.startswith("so_term", F.lit("stop"))).alias("stops")
    )


@query("fn_3_normalise", "variants", """SELECT chrom, pos, CASE WHEN pos % 2 = 0 THEN '' ELSE ref END AS ref, CASE WHEN pos % 2 = 0 THEN alt ELSE alt END AS alt, CAST(CASE WHEN pos % 2 = 0 THEN pos + 1 ELSE pos END AS INT) AS start, CAST(pos AS INT) AS "end" FROM variants""")
def fn_3(spark: SparkSession, d: str) -> DataFrame:
    v = A.variants(spark, d)
    even = F.col("pos") % 2 == 0
    k = G.normalise(F.lower("ref"), F.when(even, F.concat("ref", "alt")).otherwise(F.col("alt")), F.col("pos"))
    return v.withColumn("k", k).select("chrom", "pos", "k.ref", "k.alt", "k.start", "k.end")


@query("fn_4_arithmetic", "", "SELECT CAST(p_partkey // 100 AS BIGINT) AS bin, min(p_partkey % 100) AS least_rest, max(abs(p_size - 25)) AS spread, CAST(sum(greatest(p_size, 25) - least(p_size, 25)) AS BIGINT) AS total FROM part GROUP BY 1")
def fn_4(spark: SparkSession, d: str) -> DataFrame:
    p, s = F.col("p_partkey"), F.col("p_size")
    return A.table(spark, d, "part").groupBy(F.expr("p_partkey div 100").alias("bin")).agg(F.min(F.pmod(p, F.lit(100))).alias("least_rest"), F.max(F.abs(s - 25)).alias("spread"), F.sum(F.greatest(s, F.lit(25)) - F.least(s, F.lit(25))).alias("total"))


@query("fn_5_decimals", "", "SELECT p_size, CASE p_size % 4 WHEN 0 THEN CAST(p_size // 4 AS VARCHAR) WHEN 1 THEN CAST(p_size // 4 AS VARCHAR) || '.25' WHEN 2 THEN CAST(p_size // 4 AS VARCHAR) || '.5' ELSE CAST(p_size // 4 AS VARCHAR) || '.75' END AS shown FROM (SELECT DISTINCT p_size FROM part)")
def fn_5(spark: SparkSession, d: str) -> DataFrame:
    return A.table(spark, d, "part").select("p_size").distinct().select("p_size", G.decimal(F.col("p_size") / 4, 3).alias("shown"))


@query("fn_6_arrays", "calls", "SELECT chrom, pos, len(list_distinct(list(gt))) AS kinds, bool_or(gt = '1/1') AS any_hom, bool_and(gt <> './.') AS all_called, max(sample_id) AS last_sample, count(*) FILTER (WHERE gt = '0/1') AS hets FROM calls GROUP BY 1, 2")
def fn_6(spark: SparkSession, d: str) -> DataFrame:
    g = A.calls(spark, d).groupBy("chrom", "pos").agg(F.collect_list("gt").alias("gts"), F.collect_list("sample_id").alias("ids"))
    return g.select("chrom", "pos", F.size(F.array_distinct("gts")).cast("bigint").alias("kinds"), F.exists("gts", lambda x: x == "1/1").alias("any_hom"), F.forall("gts", lambda x: x != "./.").alias("all_called"), F.array_max("ids").alias("last_sample"), F.size(F.filter("gts", lambda x: x == "0/1")).cast("bigint").alias("hets"))


@query("fn_7_maps", "calls", "SELECT chrom, pos, count(*) FILTER (WHERE gt = '0/1') AS hets, coalesce(count(*) FILTER (WHERE gt = '9/9'), 0) AS none, count(DISTINCT gt) FILTER (WHERE gt LIKE '%1%') AS alt_kinds FROM calls GROUP BY 1, 2")
def fn_7(spark: SparkSession, d: str) -> DataFrame:
    n = A.calls(spark, d).groupBy("chrom", "pos", "gt").agg(F.count("*").alias("n")).groupBy("chrom", "pos").agg(F.map_from_entries(F.collect_list(F.struct("gt", "n"))).alias("m"))
    get = lambda k: F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(0))
    return n.select("chrom", "pos", get("0/1").alias("hets"), get("9/9").alias("none"), F.size(F.map_keys(F.map_filter("m", lambda k, v: k.contains("1")))).cast("bigint").alias("alt_kinds"))


@query("fn_8_first_non_null", "records", "SELECT coalesce(filt, '.') AS filter, count(*) AS n FROM records GROUP BY 1")
def fn_8(spark: SparkSession, d: str) -> DataFrame:
    return A.records(spark, d).groupBy(F.coalesce("filter", F.lit(".")).alias("filter")).agg(F.count("*").alias("n"))


@query("fn_9_json", "cohorts", "SELECT cohort, count(*) AS n FROM cohorts GROUP BY cohort")
def fn_9(spark: SparkSession, d: str) -> DataFrame:
    """A cohort's members to JSON text and back."""
    lists = A.cohorts(spark, d).groupBy("cohort").agg(F.array_sort(F.collect_list("sample_id")).alias("ids"))
    text = lists.select("cohort", F.to_json(F.struct("ids")).alias("j"))
    return text.select("cohort", F.size(F.from_json("j", "ids array<int>")["ids"]).cast("bigint").alias("n"))


@query("fn_10_summary_codec", "variants", "SELECT gene, count(*) AS n FROM variants GROUP BY gene")
def fn_10(spark: SparkSession, d: str) -> DataFrame:
    """Records through Spark's own row codec: written, read, equal counts."""
    path = scratch(spark, "summary")
    v = A.variants(spark, d)
    sinks.write_summary(v.groupBy("gene", "transcript").agg(F.collect_list("pos").alias("cases"), F.array().cast("array<int>").alias("controls")), path)
    from cohortspark.sources.readers import read_table

    return read_table(spark, path, "gene_summary").groupBy("gene").agg(F.sum(F.size("cases")).alias("n"))


@query("fn_13_has_data", "calls", "SELECT chrom, pos, bool_or(gt IN ('0/1', '1/1')) AS has_variant, bool_or(gt IN ('0', './.')) AS has_reference FROM calls GROUP BY 1, 2")
def fn_13(spark: SparkSession, d: str) -> DataFrame:
    g = lambda *x: F.filter(F.collect_list("gt"), lambda v: v.isin(*x))
    return A.calls(spark, d).groupBy("chrom", "pos").agg((F.size(g("0/1", "1/1")) > 0).alias("has_variant"), (F.size(g("0", "./.")) > 0).alias("has_reference"))


@query("set_1_union", "calls", "SELECT chrom, pos, count(DISTINCT sample_id) AS n, CAST(sum(DISTINCT sample_id) AS BIGINT) AS total FROM calls WHERE gt = '1/1' OR NOT pass GROUP BY 1, 2")
def set_1(spark: SparkSession, d: str) -> DataFrame:
    """Per position the samples of either list."""
    c = A.calls(spark, d)
    ids = c.where("gt = '1/1'").select("chrom", "pos", "sample_id").union(c.where("NOT pass").select("chrom", "pos", "sample_id")).distinct()
    return ids.groupBy("chrom", "pos").agg(F.count("*").alias("n"), F.sum("sample_id").alias("total"))


def _two_lists(spark: SparkSession, d: str) -> DataFrame:
    ids = lambda when: F.collect_set(F.when(when, F.col("sample_id")))
    return A.calls(spark, d).groupBy("chrom", "pos").agg(ids(F.col("gt") == "./.").alias("no_call"), ids(~F.col("pass")).alias("failed"))


@query("set_2_intersection", "calls", "SELECT chrom, pos, count(*) FILTER (WHERE gt = './.' AND NOT pass) AS n FROM calls GROUP BY 1, 2")
def set_2(spark: SparkSession, d: str) -> DataFrame:
    return _two_lists(spark, d).select("chrom", "pos", F.size(F.array_intersect("no_call", "failed")).cast("bigint").alias("n"))


@query("set_3_difference", "calls", "SELECT chrom, pos, count(*) FILTER (WHERE gt = './.' AND pass) AS n FROM calls GROUP BY 1, 2")
def set_3(spark: SparkSession, d: str) -> DataFrame:
    return _two_lists(spark, d).select("chrom", "pos", F.size(F.array_except("no_call", "failed")).cast("bigint").alias("n"))


@query("set_4_append", "calls", "SELECT gt, count(*) AS n FROM calls GROUP BY gt")
def set_4(spark: SparkSession, d: str) -> DataFrame:
    """Two loads into one folder by append."""
    path = scratch(spark, "append")
    c = A.calls(spark, d)
    for part in (0, 1):
        c.where(F.col("sample_id") % 2 == part).write.mode("append").parquet(path)
    return spark.read.schema(c.schema).parquet(path).groupBy("gt").agg(F.count("*").alias("n"))


@query("srt_1_variant_order", "call_regions", "SELECT sample_id, chrom, rstart AS start, rend AS \"end\", CAST(row_number() OVER (PARTITION BY chrom, rstart ORDER BY abs(rstart - rend), rend, sample_id, pass) AS INT) AS nr FROM call_regions")
def srt_1(spark: SparkSession, d: str) -> DataFrame:
    order = W.partitionBy("chrom", "start").orderBy(F.abs(F.col("start") - F.col("end")), "end", "sample_id", "pass")
    return A.call_regions(spark, d).select("sample_id", "chrom", "start", "end", F.row_number().over(order).alias("nr"))


@query("srt_2_position_order", "variants", "SELECT chrom, pos, coalesce(lag(pos) OVER (PARTITION BY chrom ORDER BY pos), -1) AS before FROM variants")
def srt_2(spark: SparkSession, d: str) -> DataFrame:
    """In bins, so that no task orders a chromosome."""
    return qc.preceding(A.variants(spark, d), 10_000).fillna(-1, ["before"])


@query("srt_3_sample_lists", "calls", "SELECT chrom, pos, string_agg(CAST(sample_id AS VARCHAR), ',' ORDER BY sample_id) AS ids FROM calls WHERE gt = '1/1' GROUP BY 1, 2")
def srt_3(spark: SparkSession, d: str) -> DataFrame:
    return A.calls(spark, d).where("gt = '1/1'").groupBy("chrom", "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_set("sample_id")), lambda x: x.cast("string")), ",").alias("ids"))


@query("srt_4_allele_text_order", "", "SELECT p_partkey, array_to_string(list_sort(['10', CAST(p_size AS VARCHAR), CAST(p_partkey % 12 AS VARCHAR)]), '/') AS gt FROM part")
def srt_4(spark: SparkSession, d: str) -> DataFrame:
    """Allele numbers sort as text: 10 comes before 2."""
    alleles = F.array(F.lit("10"), F.col("p_size").cast("string"), F.expr("cast(p_partkey % 12 as string)"))
    return A.table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(alleles), "/").alias("gt"))


@query("srt_5_sorted_files", "variants", "SELECT chrom, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS n FROM variants GROUP BY chrom")
def srt_5(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "sorted")
    sinks.write_variants(A.variants(spark, d), path)
    return spark.read.schema("pos int, chrom string").parquet(path).groupBy("chrom").agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.count("*").alias("n"))


@query("snk_1_8_vcf_lines", "variants", "SELECT chrom, pos, chrom || chr(9) || pos || chr(9) || '.' || chr(9) || ref || chr(9) || alt || chr(9) || '.' || chr(9) || '.' || chr(9) || 'GENE=' || gene AS line FROM variants")
def snk_8(spark: SparkSession, d: str) -> DataFrame:
    return sinks.vcf_lines(A.variants(spark, d).withColumn("info", F.concat(F.lit("GENE="), "gene")))


@query("snk_12_join_9_annotate", "variants", "SELECT v.chrom, v.pos, v.ref, v.alt, a.so_term AS so_term FROM variants v LEFT JOIN (SELECT * FROM variants WHERE pos % 3 = 0) a USING (chrom, pos, ref, alt)")
def join_9(spark: SparkSession, d: str) -> DataFrame:
    v = A.variants(spark, d)
    return annotate.annotate(v.select(*annotate.KEYS), v.where("pos % 3 = 0").select(*annotate.KEYS, "so_term"))


@query("join_7_flt_18_missing_annotation", "variants", "SELECT chrom, pos FROM variants WHERE pos % 3 <> 0")
def join_7(spark: SparkSession, d: str) -> DataFrame:
    v = A.variants(spark, d)
    return annotate.missing(v, v.where("pos % 3 = 0")).select("chrom", "pos")


@query("join_9_callable_annotator", "variants", "SELECT chrom, pos, ref, alt, pos * 2 AS score FROM variants")
def join_9b(spark: SparkSession, d: str) -> DataFrame:
    """Batches to a callable; the only Python in the engine's queries, as an annotator is foreign code."""
    return annotate.annotate_with(A.variants(spark, d), lambda f: f.assign(score=f["pos"] * 2), "chrom string, pos int, ref string, alt string, score int")


@query("flt_14_join_6_allow_list", "variants", "SELECT chrom, pos, ref, alt FROM variants WHERE pos % 7 = 0")
def flt_14(spark: SparkSession, d: str) -> DataFrame:
    """The list pads its alleles with a shared base, one position earlier."""
    v = A.variants(spark, d)
    listed = v.where("pos % 7 = 0").select("chrom", (F.col("pos") - 1).alias("pos"), F.concat(F.lit("n"), F.lower("ref")).alias("ref"), F.concat(F.lit("N"), "alt").alias("alt"))
    return filters.allow_list(v, listed).select("chrom", "pos", "ref", "alt")


@query("snk_16_query_api", "variants", "SELECT chrom, pos, ref, alt FROM variants WHERE (chrom = '3' AND pos BETWEEN 10 AND 1500 OR chrom = '5' AND pos BETWEEN 1 AND 900) AND ref IN ('A', 'C') AND so_term = 'stop_gained' ORDER BY pos LIMIT 20")
def snk_16(spark: SparkSession, d: str) -> DataFrame:
    return VariantQuery(A.variants(spark, d)).region("3:10-1500", "5:1-900").reference("A", "C").where(F.col("so_term") == "stop_gained").select("chrom", "pos", "ref", "alt").order_by("pos").limit(20).frame()


@query("fn_12_flt_17_position_keys", "variants", "SELECT chrom, pos, chrom || '_' || lpad(CAST(pos AS VARCHAR), 10, '0') AS key FROM variants")
def fn_12(spark: SparkSession, d: str) -> DataFrame:
    """Keys made, a metadata row put between them and skipped, keys read again."""
    v = A.variants(spark, d).select(keys.position_key(F.col("chrom"), F.col("pos")).alias("key"))
    rows = v.unionByName(spark.createDataFrame([(f"{keys.METADATA}_1",)], "key string")).where(~keys.is_metadata(F.col("key")))
    return rows.select(keys.parse_position_key(F.col("key")).alias("k"), "key").select("k.chrom", "k.pos", "key")
