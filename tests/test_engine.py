"""Engine loads, the stream of loads, readers and filters off the main tables."""

from __future__ import annotations

import pytest
TINY = "/root/testdata/sf0.001"
from pyspark.sql import functions as F

from cohortspark.operators import filters
from cohortspark.plans.engine import Engine
from cohortspark.schemas import schema
from cohortspark.sources import adapters as A
from cohortspark.sources import readers, sinks
from cohortspark.streaming.incremental import follow


def counted(engine):
    return sorted(map(tuple, engine.counts().groupBy("slot", "allele").count().collect()))


def test_batches_load_once_and_add_up(spark, tmp_path):
    records = A.records(spark, TINY)
    one, two = Engine(spark, f"file://{tmp_path}/one", 64), Engine(spark, f"file://{tmp_path}/two", 64)
    assert one.load(records, "all", list(range(10)))
    assert not one.load(records, "all", list(range(10)))
    assert two.load(records, "a", [0, 1, 2, 3]) and two.load(records, "b", [4, 5, 6, 7, 8, 9])
    assert counted(one) == counted(two)
    assert {r.status for r in two.batches().collect()} == {"DONE"}
    assert two.query().types("SNV").count() > 0
    two.register_views()
    assert spark.sql("SELECT count(*) FROM variant_counts").first()[0] == two.counts().count()


def test_stream_loads_what_arrives(spark, tmp_path):
    records = A.records(spark, TINY).select(*[f.name for f in schema("calls").fields])
    cast = records.select(*(F.col(f.name).cast(f.dataType) for f in schema("calls").fields))
    (tmp_path / "in").mkdir()
    engine = Engine(spark, f"file://{tmp_path}/study", 64)
    for files in ([0, 1, 2], [3, 4, 5, 6, 7, 8, 9]):
        cast.where(F.col("file_id").isin(files)).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        follow(engine, f"file://{tmp_path}/in", f"file://{tmp_path}/checkpoint").awaitTermination()
    whole = Engine(spark, f"file://{tmp_path}/whole", 64)
    whole.load(cast, "all", list(range(10)))
    assert counted(engine) == counted(whole)


def test_list_of_other_width_raises(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("1\t5\tA\tC\n\n1\t5\tA\n")
    with pytest.raises(Exception, match="four columns"):
        readers.read_pos_ref_alt(spark, f"file://{tmp_path}/l.tsv").collect()


def test_nan_is_no_frequency(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.1,)], "maf double")
    assert [r[0] for r in df.select(filters.frequency_below(F.col("maf"), F.lit("1"), 0.2, 0.3)).collect()] == [False, False, True]
    assert [r[0] for r in df.select(filters.frequency_above(F.array("maf"), 0.05)).collect()] == [False, False, True]


def test_prefilter_cutoff_is_a_share():
    with pytest.raises(ValueError, match="outside"):
        filters.stored_frequency_below(None, 2.0)


def test_vcf_header_and_body(spark, tmp_path):
    rows = spark.createDataFrame([("1", 10, "", "AG", "x=1"), ("1", 4, "A", "C", None)], "chrom string, pos int, ref string, alt string, info string")
    sinks.write_vcf(spark, rows, f"file://{tmp_path}/v", ["ALL"])
    assert spark.read.text(f"file://{tmp_path}/v/header").first()[0] == "##fileformat=VCFv4.2"
    body = {r[0] for r in spark.read.text(f"file://{tmp_path}/v/body").collect()}
    assert body == {"1\t9\t.\tN\tNAG\t.\t.\tx=1", "1\t4\t.\tA\tC\t.\t.\t."}


def test_configuration_defaults_and_names():
    from cohortspark.plans.config import AnalysisConfig, ExportConfig

    c = AnalysisConfig.of({"analysis.mr.analysis.type": "nonsense", "analysis.association.cases": "A", "analysis.association.controls": "B"})
    assert (c.maf_auto, c.maf_x, c.pop_af, c.opr, c.cadd, c.scan_cutoff) == (0.0001, 0.000125, 0.0001, 0.95, 15.0, 0.000125)
    assert AnalysisConfig.of({"analysis.mr.analysis.type": "combined", "analysis.association.cases": "A", "analysis.association.controls": "B", "analysis.prefilter.ctrl.maf": "0.01"}).scan_cutoff == 0.01
    assert ExportConfig.of({"storage.allele.opr.cohorts": "A, B", "storage.allele.opr.cutoff": "0.9"}) == ExportConfig(opr_cohorts=("A", "B"), opr=0.9)
    with pytest.raises(ValueError, match="unknown option"):
        ExportConfig.of({"storage.allele.oprs": 1})
    with pytest.raises(TypeError):
        AnalysisConfig.of({})
