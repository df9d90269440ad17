"""Queries of scans, sources, region rows, windows and interval joins."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.functions import genotype as G
from cohortspark.functions import intervals as I
from cohortspark.operators import joins, qc
from cohortspark.operators import regions as R
from cohortspark.sources import adapters as A
from cohortspark.sources import readers, sinks

from .registry import query


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder that all executors see, in the session's checkpoint folder; it goes when the process ends.

    Only a local session without a checkpoint folder gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="cohortspark-")
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_sweep)
    _made.append((spark, path))
    return path


_made: list[tuple[SparkSession, str]] = []


def _sweep() -> None:
    while _made:
        spark, path = _made.pop()
        try:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session has ended; its folder belongs to the cluster
            return


@query("src_1_file_projection", "records", "SELECT sample_id, chrom, rstart AS start, gt FROM records WHERE file_id IN (1, 3)")
def src_1(spark: SparkSession, d: str) -> DataFrame:
    return R.file_scan(A.records(spark, d), [1, 3]).select("sample_id", "chrom", "start", "gt")


@query("src_2_file_region", "records", "SELECT sample_id, chrom, rstart AS start, gt FROM records WHERE file_id IN (1, 3) AND chrom = '2' AND rstart >= 110 AND rstart < 180")
def src_2(spark: SparkSession, d: str) -> DataFrame:
    return R.region_scan(R.file_scan(A.records(spark, d), [1, 3]), "2", 110, 180).select("sample_id", "chrom", "start", "gt")


@query("src_3_region_scan", "variants", "SELECT chrom, pos, ref, alt FROM variants WHERE chrom = '10' AND pos >= 123 AND pos < 1432")
def src_3(spark: SparkSession, d: str) -> DataFrame:
    return R.region_scan(A.variants(spark, d), *readers.parse_region("10:123-1432"), pos="pos").select("chrom", "pos", "ref", "alt")


@query("src_5_count_scan", "calls", "SELECT chrom, count(*) AS n FROM calls GROUP BY chrom")
def src_5(spark: SparkSession, d: str) -> DataFrame:
    return A.calls(spark, d).groupBy("chrom").agg(F.count("*").alias("n"))


@query("src_6_key_scan", "", "SELECT DISTINCT CAST(l_partkey AS INT) AS pos FROM lineitem")
def src_6(spark: SparkSession, d: str) -> DataFrame:
    return A.table(spark, d, "lineitem").select(F.col("l_partkey").cast("int").alias("pos")).distinct()


@query("src_7_sample_filter", "calls cohorts", "SELECT sample_id, chrom, pos, gt FROM calls WHERE sample_id IN (SELECT sample_id FROM cohorts WHERE cohort = 'ASIA')")
def src_7(spark: SparkSession, d: str) -> DataFrame:
    return readers.for_samples(A.calls(spark, d), A.cohorts(spark, d).where("cohort = 'ASIA'")).select("sample_id", "chrom", "pos", "gt")


@query("src_8_region_decode", "call_regions", "SELECT sample_id, chrom, rstart AS start, rend AS \"end\" FROM call_regions WHERE rstart <= 400 AND rend >= 100")
def src_8(spark: SparkSession, d: str) -> DataFrame:
    """Rows written to every bin they touch and read back once, from the bin of their start."""
    rows = R.binned(R.touching(A.call_regions(spark, d), 100, 400), 4)
    return R.home_bin(rows, 4).select("sample_id", "chrom", "start", "end")


@query("src_9_reference_join", "calls", "SELECT a.chrom, a.pos, r.n AS n_ref, a.n AS n_alt FROM (SELECT chrom, pos, count(*) n FROM calls WHERE gt IN ('0/1', '1/1') GROUP BY 1, 2) a JOIN (SELECT chrom, pos, count(*) n FROM calls WHERE gt IN ('0', '0/0') GROUP BY 1, 2) r USING (chrom, pos)")
def src_9(spark: SparkSession, d: str) -> DataFrame:
    n = lambda gts, name: A.calls(spark, d).where(F.col("gt").isin(*gts)).groupBy("chrom", "pos").agg(F.count("*").alias(name))
    return readers.reference_and_variants(n(["0", "0/0"], "n_ref"), n(["0/1", "1/1"], "n_alt"))


@query("src_10_append_union", "calls", "SELECT chrom, CAST(sum(n) AS BIGINT) AS n FROM (SELECT chrom, count(*) n FROM calls WHERE sample_id % 2 = 0 GROUP BY 1 UNION ALL SELECT chrom, count(*) FROM calls WHERE sample_id % 3 = 0 GROUP BY 1) GROUP BY chrom")
def src_10(spark: SparkSession, d: str) -> DataFrame:
    from cohortspark.operators.merge import append_counts

    c = A.calls(spark, d)
    return append_counts(c.where("sample_id % 2 = 0"), c.where("sample_id % 3 = 0")).groupBy("chrom").agg(F.count("*").alias("n"))


@query("src_11_12_parquet_round_trip", "variants", "SELECT chrom, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum, min(ref || alt || gene) AS least FROM variants GROUP BY chrom")
def src_12(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "variants")
    sinks.write_variants(A.variants(spark, d), path)
    return spark.read.schema("pos int, ref string, alt string, gene string, chrom string").parquet(path).groupBy("chrom").agg(F.count("*").alias("n"), F.sum("pos").alias("pos_sum"), F.min(F.concat("ref", "alt", "gene")).alias("least"))


@query("src_13_row_count", "variants", "SELECT count(*) AS n FROM variants")
def src_13(spark: SparkSession, d: str) -> DataFrame:
    return A.variants(spark, d).agg(F.count("*").alias("n"))


@query("src_14_sample_collection", "cohorts", "SELECT cohort, sample_id FROM cohorts")
def src_14(spark: SparkSession, d: str) -> DataFrame:
    """Written as one JSON record and read again."""
    path = scratch(spark, "samples")
    samples = A.table(spark, d, "supplier").select(F.col("s_suppkey").cast("int").alias("sample_id"), F.col("s_name").alias("name") if "s_name" in A.table(spark, d, "supplier").columns else F.lit("s").alias("name"))
    sinks.write_sample_collection(samples, A.cohorts(spark, d), path)
    return readers.read_sample_collection(spark, path)[1]


@query("src_15_pos_ref_alt", "variants", "SELECT chrom, pos, ref, alt FROM variants")
def src_15(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "list")
    v = A.variants(spark, d)
    v.select(F.concat_ws("\t", "chrom", "pos", "ref", "alt")).union(spark.createDataFrame([("",)], "x string")).write.text(path)
    return readers.read_pos_ref_alt(spark, path)


@query("src_16_bed", "", "SELECT CAST(1 + p_partkey % 22 AS VARCHAR) AS chrom, CAST(p_partkey AS INT) AS start, CAST(p_partkey + p_size AS INT) AS \"end\" FROM part")
def src_16(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "bed")
    p = A.table(spark, d, "part")
    p.select(F.concat_ws("\t", F.expr("1 + p_partkey % 22"), F.col("p_partkey"), F.expr("p_partkey + p_size"))).union(spark.createDataFrame([("no bed line",), ("1\tx\t5",)], "x string")).write.text(path)
    return readers.read_bed(spark, path)


@query("src_17_known_blocks", "variants", """, l AS (SELECT v.chrom, p_size % 3 <> 0 AS known, row_number() OVER (PARTITION BY v.chrom ORDER BY pos) - 1 AS nr FROM variants v JOIN part ON p_partkey = pos),
b AS (SELECT *, nr - row_number() OVER (PARTITION BY chrom, known ORDER BY nr) AS block FROM l)
SELECT chrom, CAST(4 * min(nr) AS INT) AS start, CAST(4 * (max(nr) + 1) AS INT) AS "end" FROM b WHERE known GROUP BY chrom, block""")
def src_17(spark: SparkSession, d: str) -> DataFrame:
    """A FASTA file with a line of four bases per variant, unknown where the size is a multiple of three."""
    path = scratch(spark, "fasta")
    size = A.table(spark, d, "part").select(F.col("p_partkey").cast("int").alias("pos"), "p_size")
    line = F.expr("CASE WHEN p_size % 3 = 0 THEN 'NNNN' WHEN p_size % 3 = 1 THEN ref || 'CNN' ELSE repeat(ref, 4) END")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))), lambda x: x["line"])
    sequences = A.variants(spark, d).join(size, "pos").groupBy("chrom").agg(F.array_join(ordered, "\n").alias("lines"))
    sequences.select(F.concat(F.lit(">"), "chrom", F.lit(" of parts\n"), "lines")).write.text(path)
    return readers.known_blocks(readers.fasta_lines(spark, path))


@query("src_18_reference_lookup", "calls variants", "SELECT v.chrom, v.pos, coalesce(r.n, 0) AS n_ref FROM variants v LEFT JOIN (SELECT chrom, pos, count(*) n FROM calls WHERE gt IN ('0', '0/0') GROUP BY 1, 2) r USING (chrom, pos)")
def src_18(spark: SparkSession, d: str) -> DataFrame:
    ref = A.calls(spark, d).where(F.col("gt").isin("0", "0/0")).groupBy("chrom", "pos").agg(F.count("*").alias("n"))
    return A.variants(spark, d).join(ref, ["chrom", "pos"], "left").select("chrom", "pos", F.coalesce("n", F.lit(0)).alias("n_ref"))


@query("gt_5_fill_rows", "records", """
, s AS (SELECT *, CASE WHEN gt = '1/2' THEN 0 ELSE 1 END AS refs FROM records WHERE k = 5 AND gt <> './.')
SELECT sample_id, chrom, rstart + 1 AS start, rstart + 1 AS "end", CAST(refs + 1 AS INT) AS allele_count FROM s""".lstrip())
def gt_5(spark: SparkSession, d: str) -> DataFrame:
    """Here the second alternate holds the main record and one base more, which is filled."""
    return R.fill_rows(R.allele_records(A.records(spark, d))).select("sample_id", "chrom", "start", "end", "allele_count")


@query("gt_3_allele_records", "records", """
, n AS (SELECT *, unnest(CASE gt WHEN './.' THEN [-1] WHEN '0/0' THEN [0] WHEN '1/2' THEN [1, 2] WHEN '0/2' THEN [0, 2] WHEN '1/1' THEN [1] WHEN '1' THEN [1] ELSE [0, 1] END) AS allele FROM records)
SELECT sample_id, chrom, rstart AS start, CAST(CASE WHEN allele = 2 THEN rstart + 1 ELSE rend END AS INT) AS "end", CAST(allele AS INT) AS allele,
  CASE WHEN allele = 2 THEN 'DELETION' WHEN typ = 'INDEL' THEN CASE WHEN rstart > rend THEN 'INSERTION' ELSE 'DELETION' END ELSE typ END AS type,
  CAST(CASE WHEN gt IN ('0/0', '1/1') THEN 2 ELSE 1 END AS INT) AS allele_count,
  CAST(CASE WHEN allele IN (0, 1) THEN ad[allele + 1] ELSE dp END AS INT) AS depth, coalesce(filt = 'PASS', false) AS pass FROM n""".lstrip())
def gt_3(spark: SparkSession, d: str) -> DataFrame:
    return R.allele_records(A.records(spark, d)).select("sample_id", "chrom", "start", "end", "allele", "type", "allele_count", "depth", "pass")


@query("gt_6_reference_end", "records", "SELECT sample_id, chrom, rstart AS start, CAST(CASE WHEN typ = 'NO_VARIATION' THEN greatest(rend - 1, rstart) ELSE rend END AS INT) AS \"end\" FROM records")
def gt_6(spark: SparkSession, d: str) -> DataFrame:
    return R.fixed_end(A.records(spark, d), True).select("sample_id", "chrom", "start", "end")


@query("gt_7_touching", "records", "SELECT sample_id, chrom, rstart AS start FROM records WHERE rstart <= 120 AND rend >= 100")
def gt_7(spark: SparkSession, d: str) -> DataFrame:
    return R.touching(A.records(spark, d), 100, 120).select("sample_id", "chrom", "start")


@query("gt_8_kinds", "records", """
, n AS (SELECT *, unnest(CASE gt WHEN './.' THEN [-1] WHEN '0/0' THEN [0] WHEN '1/2' THEN [1, 2] WHEN '0/2' THEN [0, 2] WHEN '1/1' THEN [1] WHEN '1' THEN [1] ELSE [0, 1] END) AS allele FROM records),
x AS (SELECT chrom, allele, rstart AS s, CASE WHEN allele = 2 THEN rstart + 1 ELSE rend END AS e FROM n)
SELECT chrom, CASE WHEN allele < 0 THEN 'NOCALL' WHEN allele = 0 THEN 'REF' ELSE 'VAR' END AS kind, count(*) AS n FROM x
WHERE s = 100 AND e = 160 OR s <= 160 AND 100 <= greatest(s, e) GROUP BY 1, 2""".lstrip())
def gt_8(spark: SparkSession, d: str) -> DataFrame:
    rows = R.allele_records(A.records(spark, d))
    kind = F.when(F.col("allele") < 0, "NOCALL").when(F.col("allele") == 0, "REF").otherwise("VAR")
    return R.within(rows.withColumn("kind", kind), 100, 160).groupBy("chrom", "kind").agg(F.count("*").alias("n"))


GAPS = """
, c AS (SELECT sample_id, chrom, greatest(rstart, 1) s, least(rend, 2000) e FROM call_regions WHERE rend >= rstart AND rstart <= 2000
  UNION ALL SELECT DISTINCT sample_id, chrom, 2001, 2001 FROM call_regions),
r AS (SELECT *, coalesce(max(e) OVER (PARTITION BY sample_id, chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM c)
SELECT sample_id, chrom, CAST(upto + 1 AS INT) AS start, CAST(s - 1 AS INT) AS "end" FROM r WHERE s > upto + 1""".lstrip()


@query("gt_10_no_call_gaps", "call_regions", GAPS)
def gt_10(spark: SparkSession, d: str) -> DataFrame:
    rows = A.call_regions(spark, d)
    return R.no_call_gaps(rows, rows.select("sample_id", "chrom").distinct(), 1, 2001)


@query("win_3_missing_runs", "call_regions", GAPS.replace("SELECT sample_id, chrom, CAST(upto + 1 AS INT) AS start, CAST(s - 1 AS INT) AS \"end\" FROM r WHERE s > upto + 1", "SELECT chrom, count(*) AS n, CAST(sum(s - upto - 1) AS BIGINT) AS missing FROM r WHERE s > upto + 1 GROUP BY chrom"))
def win_3(spark: SparkSession, d: str) -> DataFrame:
    return gt_10(spark, d).groupBy("chrom").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start") + 1).alias("missing"))


@query("gt_11_positional", "call_regions", "SELECT chrom, p AS pos, count(DISTINCT sample_id) AS n FROM call_regions, unnest(range(rstart, greatest(rstart, rend) + 1)) u(p) GROUP BY 1, 2")
def gt_11(spark: SparkSession, d: str) -> DataFrame:
    return R.positional(A.call_regions(spark, d)).groupBy("chrom", F.col("pos").cast("bigint").alias("pos")).agg(F.countDistinct("sample_id").alias("n"))


@query("gt_12_intervals", "call_regions", """SELECT chrom, count(*) FILTER (WHERE rstart = 100 AND rend = 99 OR least(rstart, rend) <= 100 AND 99 <= greatest(rstart, rend)) AS plain,
  count(*) FILTER (WHERE rstart <= 100 AND 100 <= greatest(rstart, rend)) AS aware, CAST(sum(CASE WHEN rend >= rstart THEN rend - rstart + 1 ELSE rend - rstart END) AS BIGINT) AS total,
  CAST(sum(abs(rend - rstart) + 1) AS BIGINT) AS covered, count(*) FILTER (WHERE 50 <= least(rstart, rend) AND 150 >= greatest(rstart, rend)) AS inside FROM call_regions GROUP BY chrom""")
def gt_12(spark: SparkSession, d: str) -> DataFrame:
    s, e = F.col("start"), F.col("end")
    return A.call_regions(spark, d).groupBy("chrom").agg(
        F.count_if(I.overlaps(s, e, F.lit(100), F.lit(99))).alias("plain"), F.count_if(I.overlaps(s, e, F.lit(100), F.lit(99), True)).alias("aware"), F.sum(I.length(s, e)).alias("total"), F.sum(I.positions(s, e)).alias("covered"), F.count_if(I.covered_by(s, e, F.lit(50), F.lit(150))).alias("inside")
    )


@query("gt_13_clip", "call_regions", "SELECT sample_id, chrom, CAST(greatest(rstart, 100) AS INT) AS start, CAST(least(rend, 120) AS INT) AS \"end\" FROM call_regions WHERE rend >= rstart AND rstart <= 120 AND rend >= 100")
def gt_13(spark: SparkSession, d: str) -> DataFrame:
    rows = A.call_regions(spark, d).where("end >= start").withColumn("kind", F.lit("REF"))
    return R.within(rows, 100, 120).select("sample_id", "chrom", "start", "end")


@query("gt_17_bins", "call_regions", "SELECT chrom, rstart // 100 AS bin, count(*) AS n, CAST(sum(rstart % 100) AS BIGINT) AS rest FROM call_regions GROUP BY 1, 2")
def gt_17(spark: SparkSession, d: str) -> DataFrame:
    pos = F.col("start")
    return A.call_regions(spark, d).groupBy("chrom", I.bin_of(pos, 100).alias("bin")).agg(F.count("*").alias("n"), F.sum(F.pmod(pos, F.lit(100))).alias("rest"))


@query("win_4_tiles", "call_regions", """
, t AS (SELECT chrom, greatest(rstart, 100) s, least(rend, 399) e FROM call_regions WHERE rend >= rstart AND rstart <= 399 AND rend >= 100)
SELECT chrom, CAST(x AS INT) AS tile, count(*) AS n, CAST(sum(least(e, x * 4 + 3) - greatest(s, x * 4) + 1) AS BIGINT) AS positions FROM t, unnest(range(s // 4, e // 4 + 1)) u(x) GROUP BY 1, 2""".lstrip())
def win_4(spark: SparkSession, d: str) -> DataFrame:
    rows = R.tiles(A.call_regions(spark, d).where("end >= start").withColumn("kind", F.lit("REF")), 4, 100, 399)
    return rows.groupBy("chrom", "tile").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start") + 1).alias("positions"))


@query("win_1_contiguity", "variants", "SELECT chrom, count(*) AS n, count(*) FILTER (WHERE b IS NULL) AS init, count(*) FILTER (WHERE b IS NOT NULL AND pos <> b + 22) AS issues FROM (SELECT v.chrom, v.pos, lag(v.pos) OVER (PARTITION BY v.chrom ORDER BY v.pos) b FROM variants v JOIN part ON p_partkey = pos WHERE p_size % 3 <> 0) GROUP BY chrom")
def win_1(spark: SparkSession, d: str) -> DataFrame:
    return qc.contiguity(_sparse(spark, d), 22, 100)


@query("win_1_gaps", "variants", "SELECT chrom, CAST(pos + 22 AS INT) AS gap_start, CAST(a - 22 AS INT) AS gap_end FROM (SELECT v.chrom, v.pos, lead(v.pos) OVER (PARTITION BY v.chrom ORDER BY v.pos) a FROM variants v JOIN part ON p_partkey = pos WHERE p_size % 3 <> 0) WHERE a > pos + 22")
def win_1_gaps(spark: SparkSession, d: str) -> DataFrame:
    return qc.gaps(_sparse(spark, d), 22, 100)


def _sparse(spark: SparkSession, d: str) -> DataFrame:
    size = A.table(spark, d, "part").where("p_size % 3 <> 0").select(F.col("p_partkey").cast("int").alias("pos"))
    return A.variants(spark, d).join(size, "pos", "left_semi").select("chrom", "pos")


@query("join_1_reference", "calls variants", "SELECT v.chrom, v.pos, count(c.sample_id) AS n FROM variants v LEFT JOIN calls c ON c.chrom = v.chrom AND c.pos = v.pos AND c.gt = '0/0' GROUP BY 1, 2")
def join_1(spark: SparkSession, d: str) -> DataFrame:
    ref = A.calls(spark, d).where("gt = '0/0'").groupBy("chrom", "pos").agg(F.count("*").alias("n"))
    return A.variants(spark, d).join(ref, ["chrom", "pos"], "left").select("chrom", "pos", F.coalesce("n", F.lit(0)).alias("n"))


@query("join_2_range_overlap", "call_regions", "SELECT v.chrom, v.pos, count(*) AS n FROM (SELECT CAST((p_partkey // 100) % 22 + 1 AS VARCHAR) chrom, CAST(p_partkey AS INT) pos FROM part) v JOIN (SELECT CAST((rstart // 100) % 22 + 1 AS VARCHAR) chrom, rstart, rend FROM call_regions) r ON r.chrom = v.chrom AND r.rstart <= v.pos AND v.pos <= greatest(r.rstart, r.rend) GROUP BY 1, 2")
def join_2(spark: SparkSession, d: str) -> DataFrame:
    dense = F.expr("cast((start div 100) % 22 + 1 as string)")
    points = A.table(spark, d, "part").select(F.expr("cast((p_partkey div 100) % 22 + 1 as string)").alias("chrom"), F.col("p_partkey").cast("int").alias("pos"))
    ranges = A.call_regions(spark, d).withColumn("chrom", dense)
    return joins.point_in_range(points, ranges, 32).groupBy("chrom", "pos").agg(F.count("*").alias("n"))


@query("join_2_range_range", "", """SELECT a.o_orderkey AS left_id, b.o_orderkey AS right_id FROM (SELECT *, CAST(o_orderkey AS INT) s, CAST(o_orderkey + o_custkey % 9 AS INT) e FROM orders) a
JOIN (SELECT *, CAST(o_orderkey AS INT) s, CAST(o_orderkey + o_custkey % 5 AS INT) e FROM orders) b ON a.o_orderkey // 1000 % 22 = b.o_orderkey // 1000 % 22 AND a.s <= b.e AND b.s <= a.e""")
def join_2b(spark: SparkSession, d: str) -> DataFrame:
    o = A.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    chrom = "cast(o_orderkey div 1000 % 22 + 1 as string) chrom"
    a = o.selectExpr(chrom, "cast(o_orderkey as int) start", "cast(o_orderkey + o_custkey % 9 as int) end", "o_orderkey left_id")
    b = o.selectExpr(chrom, "cast(o_orderkey as int) r_start", "cast(o_orderkey + o_custkey % 5 as int) r_end", "o_orderkey right_id")
    return joins.range_overlap(a, b, 64).select("left_id", "right_id")


BED = "(SELECT CAST(1 + p_partkey % 22 AS VARCHAR) chrom, CAST(p_partkey AS INT) s, max(CAST(p_partkey + p_size AS INT)) e FROM part WHERE p_partkey % 5 = 0 AND p_partkey % 22 <> 3 GROUP BY 1, 2)"


def _bed(spark: SparkSession, d: str) -> DataFrame:
    return A.table(spark, d, "part").where("p_partkey % 5 = 0 AND p_partkey % 22 <> 3").selectExpr("cast(1 + p_partkey % 22 as string) chrom", "cast(p_partkey as int) start", "cast(p_partkey + p_size as int) end")


@query("join_3_as_of", "variants", f"SELECT v.chrom, v.pos, coalesce(b.s, -1) AS region_start, coalesce(b.e, -1) AS region_end FROM variants v ASOF LEFT JOIN {BED} b ON v.chrom = b.chrom AND v.pos >= b.s")
def join_3(spark: SparkSession, d: str) -> DataFrame:
    return joins.as_of(A.variants(spark, d).select("chrom", "pos"), _bed(spark, d), width=100).fillna(-1)


@query("flt_19_valid_region", "variants", f"SELECT v.chrom, v.pos, v.chrom NOT IN (SELECT chrom FROM {BED}) OR coalesce(b.e >= v.pos, false) AS valid FROM variants v ASOF LEFT JOIN {BED} b ON v.chrom = b.chrom AND v.pos >= b.s")
def flt_19(spark: SparkSession, d: str) -> DataFrame:
    return joins.in_valid_region(A.variants(spark, d).select("chrom", "pos"), _bed(spark, d)).select("chrom", "pos", "valid")


@query("snk_13_cleanup_report", "variants", f"SELECT so_term AS kind, CASE WHEN v.chrom NOT IN (SELECT chrom FROM {BED}) OR coalesce(b.e >= v.pos, false) THEN 'valid' ELSE 'invalid' END AS status, count(*) AS n FROM variants v ASOF LEFT JOIN {BED} b ON v.chrom = b.chrom AND v.pos >= b.s GROUP BY 1, 2")
def snk_13(spark: SparkSession, d: str) -> DataFrame:
    return qc.cleanup_report(A.variants(spark, d).select("chrom", "pos", F.col("so_term").alias("kind")), _bed(spark, d))


@query("snk_13_cleanup", "variants", f"SELECT v.chrom, v.pos FROM variants v ASOF LEFT JOIN {BED} b ON v.chrom = b.chrom AND v.pos >= b.s WHERE v.chrom NOT IN (SELECT chrom FROM {BED}) OR b.e >= v.pos")
def snk_13b(spark: SparkSession, d: str) -> DataFrame:
    return qc.cleanup(A.variants(spark, d).select("chrom", "pos"), _bed(spark, d))


@query("join_8_sample_names", "calls", "SELECT s_suppkey AS sample_id, n_name AS name, count(*) AS n FROM calls JOIN supplier ON sample_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2")
def join_8(spark: SparkSession, d: str) -> DataFrame:
    """Grouped by id first, so names join a row per sample and not per call."""
    n = A.calls(spark, d).groupBy("sample_id").agg(F.count("*").alias("n"))
    names = A.table(spark, d, "supplier").join(A.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return n.join(names, F.col("sample_id") == F.col("s_suppkey")).select(F.col("s_suppkey").alias("sample_id"), F.col("n_name").alias("name"), "n")


@query("gt_4_pass", "records", "SELECT coalesce(filt = 'PASS', false) AS pass, count(*) AS n FROM records GROUP BY 1")
def gt_4(spark: SparkSession, d: str) -> DataFrame:
    return A.records(spark, d).groupBy(G.is_pass(F.col("filter")).alias("pass")).agg(F.count("*").alias("n"))


@query("gt_9_region_lookup", "call_regions variants", "SELECT v.chrom, v.pos, count(*) AS n, count(DISTINCT sample_id) AS samples FROM variants v JOIN call_regions r ON r.chrom = v.chrom AND r.rstart <= v.pos AND v.pos <= greatest(r.rstart, r.rend) GROUP BY 1, 2")
def gt_9(spark: SparkSession, d: str) -> DataFrame:
    """Rows at each variant's position, insertions at their start only."""
    points = A.variants(spark, d).select("chrom", "pos")
    return joins.point_in_range(points, A.call_regions(spark, d), 64).groupBy("chrom", "pos").agg(F.count("*").alias("n"), F.countDistinct("sample_id").alias("samples"))


@query("join_5_cohort_semi", "calls cohorts", "SELECT gt, count(*) AS n FROM calls WHERE sample_id IN (SELECT sample_id FROM cohorts WHERE cohort = 'EUROPE') GROUP BY gt")
def join_5(spark: SparkSession, d: str) -> DataFrame:
    return readers.for_samples(A.calls(spark, d), A.cohorts(spark, d).where("cohort = 'EUROPE'")).groupBy("gt").agg(F.count("*").alias("n"))


@query("snk_10_gene_summary", "variants", "SELECT transcript, max(gene) AS gene, count(*) AS n_cases FROM variants GROUP BY transcript")
def snk_10(spark: SparkSession, d: str) -> DataFrame:
    """Gene summaries written with Snappy and read by their schema."""
    path = scratch(spark, "genes")
    rows = A.variants(spark, d).groupBy("transcript").agg(F.max("gene").alias("gene"), F.array_sort(F.collect_set("pos")).alias("cases"), F.array().cast("array<int>").alias("controls"))
    sinks.write_summary(rows, path)
    return readers.read_table(spark, path, "gene_summary").select("transcript", "gene", F.size("cases").cast("bigint").alias("n_cases"))


@query("snk_14_table_rewrite", "variants", "SELECT chrom, count(*) AS n FROM variants WHERE pos % 2 = 0 GROUP BY chrom")
def snk_14(spark: SparkSession, d: str) -> DataFrame:
    """A table rewritten with the rows to keep, chromosome by chromosome."""
    path = scratch(spark, "rewrite")
    v = A.variants(spark, d)
    sinks.write_variants(v, path)
    old = spark.read.schema(v.schema).parquet(path)
    new = f"{path}-new"
    sinks.write_variants(old.where("pos % 2 = 0"), new)
    return spark.read.schema(v.schema).parquet(new).groupBy("chrom").agg(F.count("*").alias("n"))


@query("snk_15_pruned_scan", "variants", "SELECT chrom, pos, gene, so_term FROM variants WHERE cadd_scaled >= 2 AND chrom = '4'")
def snk_15(spark: SparkSession, d: str) -> DataFrame:
    """Score range over sorted files: the partition is pruned and the range pushed to row groups."""
    path = scratch(spark, "scores")
    v = A.variants(spark, d)
    sinks.write_variants(v, path, pos="cadd_scaled")
    return spark.read.schema(v.schema).parquet(path).where("cadd_scaled >= 2 AND chrom = '4'").select("chrom", "pos", "gene", "so_term")


@query("snk_5_6_study_metadata", "cohorts", "SELECT cohort, sample_id, n_name AS name FROM cohorts JOIN supplier ON sample_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey")
def snk_5(spark: SparkSession, d: str) -> DataFrame:
    """The study's metadata as one record of two maps."""
    nation = A.table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("name"))
    samples = A.table(spark, d, "supplier").select(F.col("s_suppkey").cast("int").alias("sample_id"), "s_nationkey").join(nation, "s_nationkey").select("sample_id", "name")
    one = sinks.sample_collection(samples, A.cohorts(spark, d))
    ids = one.select("samples", F.explode("cohorts").alias("cohort", "ids")).select("samples", "cohort", F.explode("ids").alias("sample_id"))
    return ids.select("cohort", "sample_id", F.col("samples")[F.col("sample_id").cast("string")].alias("name"))
