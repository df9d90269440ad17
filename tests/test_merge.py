"""The merge at scale: what goes before its join, long blocks, and loads that add files only."""

from __future__ import annotations

import glob
import os

import pytest

from cohortspark.operators import filters
from cohortspark.operators import merge as M
from cohortspark.operators import regions as R
from cohortspark.plans.engine import Engine
from cohortspark.plans.query import SLOTS, VariantQuery, slot_columns
from cohortspark.sources import adapters as A
from cohortspark.sources import readers, sinks

TINY = "/root/testdata/sf0.001"
REGION = "chrom string, start int, end int, kind string, ref string, alt string, type string, allele_count int, depth int, pass boolean, sample_id int"
CALL = "sample_id int, file_id int, chrom string, start int, end int, ref string, alt string, type string, sec_alts array<struct<start:int,end:int,ref:string,alt:string,type:string>>, gt string, dp int, ad array<int>, filter string"


def ref(sample, start, end, count=2, ok=True, kind="REF"):
    return ("1", start, end, kind, None, None, "NO_VARIATION", count, 9, ok, sample)


def snv(sample, pos, count=1, alt="G"):
    return ("1", pos, pos, "VAR", "A", alt, "SNV", count, 9, True, sample)


def merged(spark, rows, **how):
    return sorted(map(tuple, M.slots(M.merge(spark.createDataFrame(rows, REGION), **how)).collect()))


def test_hom_ref_goes_before_the_join(spark):
    """Nine tenths of the input is plain hom-ref: no row of it reaches the join, and the result is the same without it."""
    told = [snv(s, 100 + 10 * s) for s in range(10)] + [ref(s, 90, 400, 1, kind="NOCALL") for s in range(0, 10, 3)] + [ref(4, 50, 300, 2, ok=False)]
    plain = [ref(s, 1 + 200 * k, 180 + 200 * k) for s in range(10) for k in range(14)]
    assert len(plain) > 0.9 * len(told + plain)
    df = M.merge(spark.createDataFrame(told + plain, REGION))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    join = min(plan.find(x) for x in ("Join Inner", "Join LeftOuter") if x in plan)
    assert plan.rfind("NOT (kind") > join and "(allele_count" in plan[plan.rfind("NOT (kind") :]
    met = M.numbers(spark.createDataFrame(told + plain, REGION).where(~M.plain_reference()))
    assert met.count() == M.numbers(spark.createDataFrame(told, REGION)).count()
    assert merged(spark, told + plain) == merged(spark, told)


def test_long_blocks_are_dealt_by_the_variants(spark):
    """A block of megabases without calls becomes as many rows as bins with a variant."""
    rows = [snv(1, p) for p in (5, 70_000, 2_000_000, 2_999_990)] + [ref(2, 1, 3_000_000, 1, kind="NOCALL")]
    df = spark.createDataFrame(rows, REGION)
    at = M.variant_keys(df).selectExpr("chrom", "pos div 128 _bin")
    from cohortspark.operators.joins import dealt

    assert dealt(df.where("kind = 'NOCALL'"), 128, at).count() == 4
    assert [r for r in merged(spark, rows) if r[-1] == 2] == [("1", p, "A", "G", "R", -1, 2) for p in (5, 70_000, 2_000_000, 2_999_990)]
    assert merged(spark, rows) == merged(spark, rows, width=8) == merged(spark, rows, width=4096)


def test_one_shuffle_after_the_join(spark):
    """Without broadcasts the join's partitions serve the aggregate and the statistics by variant."""
    df = spark.createDataFrame([snv(1, 5), snv(2, 9)], REGION)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = M.merge(df, keep_bin=True).groupBy("chrom", "_bin", *M.VARIANT[1:]).count()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    above = plan[: plan.find("Join")]
    assert "Exchange" not in above


def call(sample, start, end, ref_, alt, kind, gt, filter="PASS"):
    return (sample, sample, "1", start, end, ref_, alt, kind, [], gt, 9, [4, 5], filter)


def files(path):
    return {os.path.relpath(f, path): os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.fixture
def calls(spark):
    rows = [call(s, p, p, "A", "G", "SNV", "0/1") for s in (0, 1, 2) for p in (10, 1500, 2500)] + [call(1, 100, 2200, "", "", "NO_VARIATION", "./.")]
    rows += [call(7, 1500, 1500, "A", "T", "SNV", "1/1"), call(7, 1600, 1600, "A", "C", "SNV", "0/1"), call(1, 1600, 1600, "A", "C", "SNV", "0/1")]
    return spark.createDataFrame(rows, CALL)


def slots(engine):
    return sorted(map(tuple, engine.counts().collect()))


def test_a_batch_writes_its_own_stretch_only(spark, calls, tmp_path):
    engine, whole = Engine(spark, f"file://{tmp_path}/study", 1024), Engine(spark, f"file://{tmp_path}/whole", 1024)
    first = calls.where("NOT (file_id = 7 OR start = 1600)")
    engine.load(first, "a", [0, 1, 2])
    before = files(f"{tmp_path}/study/variant_counts")
    engine.load(calls.where("file_id = 7"), "b", [7])
    after = files(f"{tmp_path}/study/variant_counts")
    assert {f: after[f] for f in before} == before
    assert {os.path.dirname(f) for f in set(after) - set(before)} == {"chrom=1/span=1/batch_id=b"}
    whole.load(first.unionByName(calls.where("file_id = 7")), "all", [0, 1, 2, 7])
    assert slots(engine) == slots(whole)


def test_a_sample_may_come_again(spark, calls, tmp_path):
    """A second file of a sample replaces the sample's entries where it has rows, and no one else's."""
    engine, whole = Engine(spark, f"file://{tmp_path}/study", 1024), Engine(spark, f"file://{tmp_path}/whole", 1024)
    engine.load(calls.where("NOT (sample_id = 1 AND start = 1600)"), "a", [0, 1, 2, 7])
    engine.load(calls.where("sample_id = 1 AND start = 1600"), "b", [1])
    whole.load(calls, "all", [0, 1, 2, 7])
    assert slots(engine) == slots(whole)
    assert sorted(map(tuple, engine.regions().drop("batch_id").collect()), key=str) == sorted(map(tuple, whole.regions().drop("batch_id").collect()), key=str)
    engine.drop()
    assert not os.path.exists(f"{tmp_path}/study")


def test_a_failed_batch_is_not_seen(spark, calls, tmp_path, monkeypatch):
    engine, whole = Engine(spark, f"file://{tmp_path}/study", 1024), Engine(spark, f"file://{tmp_path}/whole", 1024)
    engine.load(calls, "a", [0, 1, 2])
    seen = slots(engine)
    with monkeypatch.context() as m:
        m.setattr(Engine, "_merge", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            engine.load(calls, "b", [7])
    assert slots(engine) == seen
    assert engine.load(calls, "b", [7])
    whole.load(calls, "all", [0, 1, 2, 7])
    assert slots(engine) == slots(whole)


def test_a_folder_and_a_file_for_each_stretch_of_counts_only(spark, tmp_path):
    """Many short stretches: what loads read has no folder for each, and the merge's partitions fill each folder from one task."""
    engine, whole = Engine(spark, f"file://{tmp_path}/study", 16), Engine(spark, f"file://{tmp_path}/whole", 1024)
    calls = A.records(spark, TINY)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold") if spark.conf.get(k, None)}
    try:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(k, "-1")
        engine.load(calls, "a", [0, 1, 2, 3, 4])
        engine.load(calls, "b", [5, 6, 7, 8, 9])
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(k, kept[k]) if k in kept else spark.conf.unset(k)
    whole.load(calls, "all", list(range(10)))
    assert slots(engine) == slots(whole)
    assert not any("span=" in f for name in ("call_regions", "variant_keys") for f in files(f"{tmp_path}/study/{name}"))
    counts = files(f"{tmp_path}/study/variant_counts")
    assert len(counts) == len({os.path.dirname(f) for f in counts}) > 20
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_variants_that_a_batch_brings_meet_the_other_samples(spark):
    """Rows of samples that were loaded before meet fresh variants alone."""
    rows = [(*snv(1, 5), False), (*snv(2, 5, alt="T"), True), (*snv(2, 9), True)]
    told = spark.createDataFrame(rows, REGION + ", fresh_only boolean")
    keys = spark.createDataFrame([("1", 5, "A", "G", True), ("1", 5, "A", "T", False), ("1", 9, "A", "G", False)], "chrom string, pos int, ref string, alt string, fresh boolean")
    got = sorted((r.pos, r.alt, r.sample_id, r.a) for r in M.merge(told, variants=keys).collect())
    assert got == [(5, "G", 1, 1), (5, "G", 2, 0), (5, "T", 1, 0)]


def test_usual_genotypes_are_counted_as_parsed(spark):
    from pyspark.sql import functions as F

    from cohortspark.functions import genotype as G

    for gt, counts in G.USUAL_COUNTS.items():
        n = [int(x) for x in gt.replace("|", "/").split("/") if x != "."] or [-1]
        assert dict(zip(counts[::2], counts[1::2])) == {x: n.count(x) for x in n}
    rows = spark.createDataFrame([("0/3",), ("1",), (None,), ("2|2",)], "gt string")
    assert [r[0] for r in rows.select(G.allele_counts(F.col("gt"))).collect()][:2] == [{0: 1, 3: 1}, {1: 1}]


def test_genotypes_of_the_long_table_and_of_lists(spark, tmp_path):
    M.slots(M.merge(R.call_regions(A.records(spark, TINY)), width=8)).write.parquet(f"file://{tmp_path}/c")
    counts = spark.read.parquet(f"file://{tmp_path}/c")
    for wanted in ({7: ("1/1",)}, {3: ("0/1", "."), 7: ("!0/0",)}, {1: ("0/0",)}, {2: ("0/2",)}):
        by_list = VariantQuery(slot_columns(counts, SLOTS)).genotype(wanted).select(*M.VARIANT).frame()
        long = VariantQuery(counts.select(*M.VARIANT).distinct(), counts).genotype(wanted).select(*M.VARIANT).frame()
        assert sorted(map(tuple, by_list.collect())) == sorted(map(tuple, long.collect()))
    plan = filters.sample_entries(counts, [7], M.VARIANT)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_" not in plan


def test_lists_of_some_samples(spark):
    counts = spark.createDataFrame([("1", 1, "A", "G", "V", 1, s) for s in range(5)], "chrom string, pos int, ref string, alt string, slot string, allele int, sample_id int")
    assert slot_columns(counts, SLOTS, [1, 3]).first().V1 == [1, 3]


def test_the_frequency_reaches_the_scan(spark, tmp_path):
    rows = spark.range(1000).selectExpr("'1' chrom", "cast(id as int) pos", "cast(CASE WHEN id % 10 = 0 THEN NULL ELSE id / 2000 END as float) maf")
    sinks.write_analysis(rows, f"file://{tmp_path}/t")
    scan = readers.frequency_scan(spark.read.schema("pos int, maf float, chrom string").parquet(f"file://{tmp_path}/t"), 0.1)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.find("PushedFilters:") :].splitlines()[0]
    assert "IsNull(maf)" in pushed and "LessThan(maf," in pushed
    assert scan.count() == 100 + 180
