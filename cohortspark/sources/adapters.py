"""Genotype views over the driver's tables: suppliers are samples, parts are positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order(line: str = "") -> F.Column:
    return F.expr("(l_orderkey * 8 + l_linenumber) * 64 + l_quantity")


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One genotype per sample and position: sample_id, chrom, pos, gt, pass."""
    line = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    one = line.groupBy(F.col("l_suppkey").cast("int").alias("sample_id"), F.col("l_partkey").cast("int").alias("pos")).agg(
        F.min_by(F.struct("l_quantity", "l_returnflag"), _order()).alias("x")
    )
    gt = F.expr("element_at(array('./.', '0/1', '1/1', '0', '0/0', '0/0', '0/0', '0/0'), cast(cast(x.l_quantity as bigint) % 8 + 1 as int))")
    return one.select("sample_id", F.expr("cast(1 + pos % 22 as string)").alias("chrom"), "pos", gt.alias("gt"), (F.col("x.l_returnflag") != "R").alias("pass"))


def cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cohort per region, and ALL: cohort, sample_id."""
    sample = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("sample_id"), "s_nationkey")
    named = sample.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.select(F.col("r_name").alias("cohort"), "sample_id").unionByName(sample.select(F.lit("ALL").alias("cohort"), "sample_id"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated variants: chrom, pos, ref, alt, gene, transcript, so_term, biotype, cadd_scaled."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(1 + p_partkey % 22 as string) chrom",
        "cast(p_partkey as int) pos",
        "substr('ACGT', cast(1 + p_partkey % 4 as int), 1) ref",
        "substr('CGTA', cast(1 + p_partkey % 4 as int), 1) alt",
        "p_brand gene",
        "p_brand || '.' || cast(p_size as string) transcript",
        "CASE p_type WHEN 'ECONOMY' THEN 'stop_gained' WHEN 'PROMO' THEN 'frameshift_variant' WHEN 'SMALL' THEN 'missense_variant' WHEN 'MEDIUM' THEN 'inframe_deletion' WHEN 'LARGE' THEN 'synonymous_variant' ELSE 'intron_variant' END so_term",
        "CASE WHEN p_size % 5 = 0 THEN 'lincRNA' ELSE 'protein_coding' END biotype",
        "cast((p_retailprice - 900) * 0.4 as double) cadd_scaled",
    )


def call_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of samples: sample_id, chrom, start, end, pass; line 7 gives an insertion."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_suppkey as int) sample_id",
        "cast(1 + l_partkey % 22 as string) chrom",
        "cast(l_partkey as int) start",
        "cast(CASE WHEN l_linenumber = 7 THEN l_partkey - 1 ELSE l_partkey + l_linenumber - 1 END as int) end",
        "l_returnflag <> 'R' pass",
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call records on dense positions (a hundred a chromosome), one per sample and position, so that alleles overlap.

    By (sample + position) mod 6 a record is an SNV A>G, an SNV A>T, a deletion of ACG, an
    insertion of CC, a reference block of four, or an SNV A>G with the deletion of AC as
    second alternate. sample_id, file_id, chrom, start, end, ref, alt, type, sec_alts, gt, dp, ad, filter.
    """
    line = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    one = line.groupBy(F.col("l_suppkey").cast("int").alias("sample_id"), F.col("l_partkey").cast("int").alias("start")).agg(
        F.min_by(F.struct("l_quantity", "l_returnflag"), _order()).alias("x")
    )
    one = one.withColumns({"k": F.expr("(sample_id + start) % 6"), "q": F.expr("cast(x.l_quantity as bigint) % 8")})
    pick = lambda *xs: F.expr("element_at(array(" + ", ".join(xs) + "), k + 1)")
    gt = F.expr("CASE WHEN q = 0 THEN './.' WHEN k = 4 THEN '0/0' WHEN k = 5 THEN CASE WHEN q < 4 THEN '1/2' ELSE '0/2' END WHEN q = 2 THEN '1/1' WHEN q = 3 THEN '1' ELSE '0/1' END")
    second = F.expr("CASE WHEN k = 5 THEN array(named_struct('start', start, 'end', start + 1, 'ref', 'AC', 'alt', '', 'type', 'INDEL')) ELSE cast(array() as array<struct<start:int,end:int,ref:string,alt:string,type:string>>) END")
    return one.select(
        "sample_id",
        F.expr("sample_id % 10").alias("file_id"),
        F.expr("cast((start div 100) % 22 + 1 as string)").alias("chrom"),
        "start",
        pick("start", "start", "start + 2", "start - 1", "start + 3", "start").alias("end"),
        pick("'A'", "'A'", "'ACG'", "''", "''", "'A'").alias("ref"),
        pick("'G'", "'T'", "''", "'CC'", "''", "'G'").alias("alt"),
        pick("'SNV'", "'SNV'", "'INDEL'", "'INDEL'", "'NO_VARIATION'", "'SNV'").alias("type"),
        second.alias("sec_alts"),
        gt.alias("gt"),
        F.expr("cast(x.l_quantity as int)").alias("dp"),
        F.expr("array(cast(q as int), cast(q * 2 as int))").alias("ad"),
        F.expr("CASE WHEN x.l_returnflag = 'R' THEN 'LowQ' WHEN x.l_returnflag = 'A' THEN NULL ELSE 'PASS' END").alias("filter"),
    )


#: The same views for DuckDB, by name.
SQL = {
    "calls": """calls AS (SELECT CAST(l_suppkey AS INT) sample_id, CAST(1+l_partkey%22 AS VARCHAR) chrom, CAST(l_partkey AS INT) pos,
  CASE CAST(min_by(l_quantity, (l_orderkey*8+l_linenumber)*64+l_quantity) AS BIGINT)%8 WHEN 0 THEN './.' WHEN 1 THEN '0/1' WHEN 2 THEN '1/1' WHEN 3 THEN '0' ELSE '0/0' END gt,
  min_by(l_returnflag, (l_orderkey*8+l_linenumber)*64+l_quantity) <> 'R' pass FROM lineitem GROUP BY 1, 2, 3)""",
    "cohorts": """cohorts AS (SELECT r_name cohort, CAST(s_suppkey AS INT) sample_id FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey
  UNION ALL SELECT 'ALL', CAST(s_suppkey AS INT) FROM supplier)""",
    "variants": """variants AS (SELECT CAST(1+p_partkey%22 AS VARCHAR) chrom, CAST(p_partkey AS INT) pos, substr('ACGT',CAST(1+p_partkey%4 AS INT),1) ref, substr('CGTA',CAST(1+p_partkey%4 AS INT),1) alt,
  p_brand gene, p_brand||'.'||CAST(p_size AS VARCHAR) transcript,
  CASE p_type WHEN 'ECONOMY' THEN 'stop_gained' WHEN 'PROMO' THEN 'frameshift_variant' WHEN 'SMALL' THEN 'missense_variant' WHEN 'MEDIUM' THEN 'inframe_deletion' WHEN 'LARGE' THEN 'synonymous_variant' ELSE 'intron_variant' END so_term,
  CASE WHEN p_size%5=0 THEN 'lincRNA' ELSE 'protein_coding' END biotype, CAST((p_retailprice-900)*0.4 AS DOUBLE) cadd_scaled FROM part)""",
    "call_regions": """call_regions AS (SELECT CAST(l_suppkey AS INT) sample_id, CAST(1+l_partkey%22 AS VARCHAR) chrom, CAST(l_partkey AS INT) AS rstart,
  CAST(CASE WHEN l_linenumber=7 THEN l_partkey-1 ELSE l_partkey+l_linenumber-1 END AS INT) AS rend, l_returnflag<>'R' pass FROM lineitem)""",
    "records": """one AS (SELECT CAST(l_suppkey AS INT) sample_id, CAST(l_partkey AS INT) AS rstart, min_by(l_quantity, (l_orderkey*8+l_linenumber)*64+l_quantity) qty, min_by(l_returnflag, (l_orderkey*8+l_linenumber)*64+l_quantity) flag FROM lineitem GROUP BY 1, 2),
records AS (SELECT sample_id, sample_id % 10 file_id, CAST((rstart // 100) % 22 + 1 AS VARCHAR) chrom, rstart, (sample_id + rstart) % 6 k, CAST(qty AS BIGINT) % 8 q,
  [rstart, rstart, rstart+2, rstart-1, rstart+3, rstart][k+1] rend, ['A','A','ACG','','','A'][k+1] ref, ['G','T','','CC','','G'][k+1] alt, ['SNV','SNV','INDEL','INDEL','NO_VARIATION','SNV'][k+1] AS typ,
  CASE WHEN q=0 THEN './.' WHEN k=4 THEN '0/0' WHEN k=5 THEN CASE WHEN q<4 THEN '1/2' ELSE '0/2' END WHEN q=2 THEN '1/1' WHEN q=3 THEN '1' ELSE '0/1' END gt,
  CAST(qty AS INT) dp, [CAST(q AS INT), CAST(q*2 AS INT)] ad, CASE WHEN flag='R' THEN 'LowQ' WHEN flag='A' THEN NULL ELSE 'PASS' END filt FROM one)""",
}


def with_views(names: str, body: str) -> str:
    """``body`` behind the named views."""
    return "WITH " + ",\n".join(SQL[n] for n in names.split()) + "\n" + body
