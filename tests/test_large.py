"""Plans that must not grow faster than their tables."""

from __future__ import annotations

from cohortspark.sources import readers

TINY = "/root/testdata/sf0.001"


def test_a_sequence_is_not_read_again_for_each_line(spark, tmp_path):
    """The name is taken off the sequence before its lines are dealt out."""
    (tmp_path / "f.fa").write_text(">7 of parts\nACGT\n\nNNNN\n > \n>8\n")
    rows = readers.fasta_lines(spark, f"file://{tmp_path}/f.fa")
    assert sorted((r.chrom, r.line, r.pos) for r in rows.collect())[-2:] == [("7", "ACGT", 0), ("7", "NNNN", 4)]
    above = rows._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "value" not in above


def test_a_record_takes_no_column_of_every_sample(spark, tmp_path):
    """With forty samples a file id, gVCF lines stay narrow and all records come back."""
    from pyspark.sql import functions as F

    from cohortspark.plans import queries_merge as Q
    from cohortspark.sources import adapters as A
    from cohortspark.sources import vcf

    tables = f"file://{tmp_path}/tables"
    line = A.table(spark, TINY, "lineitem")
    line.withColumn("l_suppkey", F.expr("l_orderkey % 400")).write.parquet(f"{tables}/lineitem.parquet")
    spark.range(400).select(F.col("id").alias("s_suppkey")).write.parquet(f"{tables}/supplier.parquet")
    samples = Q._vcf_text(spark, tables, f"file://{tmp_path}/vcf")
    text = spark.read.text(f"file://{tmp_path}/vcf").where("value NOT LIKE '##%'")
    assert text.agg(F.max(F.size(F.split("value", "\t")))).first()[0] <= 9 + 16
    cols = ["sample_id", "chrom", "start", "end", "ref", "alt", "type", "gt", "dp", "filter"]
    got, want = vcf.read_vcf(spark, f"file://{tmp_path}/vcf", samples).select(cols), A.records(spark, tables).select(cols)
    assert want.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_written_variants_are_made_once(spark, tmp_path):
    """No run of all that makes the rows finds the ranges first."""
    from cohortspark.sources import sinks

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(200_000, numPartitions=2).selectExpr("cast(id % 3 as string) chrom", "cast(id as int) pos")
    sinks.write_variants(rows.mapInArrow(count, rows.schema), f"file://{tmp_path}/v")
    assert made.value == 200_000 == spark.read.parquet(f"file://{tmp_path}/v").count()


def test_genotypes_are_made_once_for_their_classes(spark):
    """One aggregate finds all lists, those of variants without a member of the cohort too."""
    from cohortspark.operators import genotypes as GT

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = [("1", 5, "A", "G", ["A", "G"], s, gt) for s, gt in ((1, "0/1"), (2, "1"), (3, "1"), (4, "0/0"), (9, "."))] + [("1", 6, "A", "G", ["A", "G"], 9, "1/1")]
    g = spark.createDataFrame(rows, "chrom string, pos int, ref string, alt string, alleles array<string>, sample_id int, gt string")
    cohort = spark.createDataFrame([(s,) for s in range(1, 8)], "sample_id int")
    got = {r.pos: (r.no_call, r.het, r.hom_alt, r.other, r.hom_ref_count) for r in GT.genotype_classes(g.mapInArrow(count, g.schema), cohort).collect()}
    assert got == {5: ([], [1], [], {"1": [2, 3]}, 4), 6: (None, None, None, None, 7)}
    assert made.value == len(rows)


def test_the_merge_meets_in_as_many_partitions_as_are_asked(spark):
    """Large tables don't meet in the session's few partitions; the variants' groups stay in them."""
    from cohortspark.operators import genotypes as GT
    from cohortspark.operators import merge as M
    from cohortspark.operators import regions as R
    from cohortspark.sources import adapters as A

    rows = R.call_regions(A.records(spark, TINY)).localCheckpoint()
    few, many = M.merge(rows, width=8, keep_bin=True), M.merge(rows, width=8, keep_bin=True, parts=23)
    assert many.rdd.getNumPartitions() == 23
    assert many.exceptAll(few).isEmpty() and many.count() == few.count()
    plan = GT.sample_genotypes(many)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.find("Join")]


def test_sets_of_cohorts_are_counted_like_their_members(spark):
    """Rows are joined to the sets of cohorts that their samples are in, so no row is written out for each cohort."""
    from cohortspark.operators import stats

    rows = [("1", 5, "A", "G", "SNV", s, 1, 1, *[None] * 6, s == 3) for s in range(1, 6)]
    merged = spark.createDataFrame(rows, "chrom string, pos int, ref string, alt string, type string, sample_id int, a int, reference int, sec_A int, sec_C int, sec_T int, sec_G int, sec_del int, sec_ins int, not_pass boolean")
    cohorts = spark.createDataFrame([("all", s) for s in range(1, 9)] + [("low", s) for s in (1, 2, 3)] + [("twice", s) for s in (3, 3)] + [("none", 8)], "cohort string, sample_id int")
    got = stats.cohort_statistics(merged, cohorts)
    assert {r.cohort: (r.alt_ac, r.ref_ac, r.not_pass, r.num_samples) for r in got.collect()} == {"all": (5, 11, 1, 8), "low": (3, 3, 1, 3), "twice": (2, 2, 2, 2)}
    assert "_set" in got._jdf.queryExecution().optimizedPlan().toString()


def test_summaries_say_what_classes_and_statistics_say(spark):
    """One pass over the genotypes gives the export's lists and counts, samples of no cohort included."""
    from cohortspark.operators import genotypes as GT
    from cohortspark.operators import merge as M
    from cohortspark.operators import regions as R
    from cohortspark.operators import stats, summaries
    from cohortspark.sources import adapters as A

    merged = M.merge(R.call_regions(A.records(spark, TINY)), width=8, keep_bin=True)
    merged = spark.createDataFrame(merged.collect(), merged.schema)
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    g = GT.sample_genotypes(merged)
    cohorts = A.cohorts(spark, TINY).where("sample_id NOT IN (3, 7)")
    some = cohorts.where("sample_id < 3").select("sample_id")
    rows = summaries.variant_summaries(g.mapInArrow(count, g.schema), cohorts, some).collect()
    assert made.value == merged.count()
    told = spark.createDataFrame(rows, summaries.variant_summaries(g, cohorts, some).schema)
    text = lambda df: sorted(str(sorted(r.asDict(True).items())) for r in df.collect())
    classes = GT.genotype_classes(g, some)
    assert text(summaries.classes(told, some)) == text(classes)
    assert classes.where("size(other) > 1").count() > 0
    assert text(summaries.statistics(told, cohorts)) == text(stats.cohort_statistics(merged, cohorts).drop("_bin"))


def test_wide_lines_are_written_small(spark, tmp_path):
    """Lines of many samples: whole, in order, made after the rows are ordered, and as small on disk as what they say."""
    import glob
    import os

    from cohortspark.sources import vcf

    n, at = 5000, {7: "0/1", 2500: "1/1", 4999: "."}
    rows = [("1", p, "A", "G", ["A", "G"], s, gt) for p in range(100, 0, -1) for s, gt in at.items()]
    g = spark.createDataFrame(rows, "chrom string, pos int, ref string, alt string, alleles array<string>, sample_id int, gt string")
    samples = spark.range(n).selectExpr("cast(id as int) sample_id", "concat('s', id) name")
    entries = vcf.sample_entries(g, samples)
    assert sorted(map(tuple, vcf.sample_lines(entries, samples).collect())) == sorted(map(tuple, vcf.sample_lines(g, samples).collect()))
    vcf.write_sample_vcf(spark, entries, samples, f"file://{tmp_path}/out", compression="lz4")
    body = [r[0] for r in spark.read.text(f"file://{tmp_path}/out/body").collect()]
    assert sorted(body) == sorted("\t".join(["1", str(p), ".", "A", "G", ".", ".", ".", "GT", *(at.get(s, "0/0") for s in range(n))]) for p in range(1, 101))
    files = sorted(glob.glob(f"{tmp_path}/out/body/part-*"))
    assert sum(map(os.path.getsize, files)) < 0.05 * sum(map(len, body))
    firsts = [[int(r[0].split("\t")[1]) for r in spark.read.text(f"file://{f}").collect()] for f in files]
    assert sum(firsts, []) == list(range(1, 101))
