"""Golden cases of the domain: genotypes, types, intervals, tiles, the seven-sample merge and the combiner."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortspark.functions import genotype as G
from cohortspark.functions import intervals as I
from cohortspark.functions.hwe import exact_p
from cohortspark.operators import genotypes as GT
from cohortspark.operators import merge as M
from cohortspark.operators import regions as R
from cohortspark.operators import stats
from cohortspark.schemas import NAMES, schema
from cohortspark.sources.readers import parse_region

CALL = "sample_id int, file_id int, chrom string, start int, end int, ref string, alt string, type string, sec_alts array<struct<start:int,end:int,ref:string,alt:string,type:string>>, gt string, dp int, ad array<int>, filter string"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(("gt", "want"), [(".", {-1: 1}), ("./.", {-1: 1}), ("0/0", {0: 2}), ("0", {0: 1}), ("./0", {0: 1}), ("0/1", {0: 1, 1: 1}), ("./1", {1: 1}), ("1|2", {1: 1, 2: 1})])
def test_allele_counts(spark, gt, want):
    assert one(spark, G.allele_counts(F.lit(gt))) == want


@pytest.mark.parametrize(("ref", "alt", "want"), [("", ".", "NO_VARIATION"), ("A", "T", "SNV"), ("AGG", "TCC", "MNV"), ("", "T", "INSERTION"), (".", "T", "INSERTION"), ("A", "", "DELETION"), ("A", ".", "DELETION"), ("AG", "T", "MIXED"), ("A", "TC", "MIXED")])
def test_types(spark, ref, alt, want):
    assert one(spark, G.infer_type(F.lit(ref), F.lit(alt))) == want


@pytest.mark.parametrize("alt", ["<ABC>", ".A", "[A", "[T", ".T", "<T>"])
def test_symbolic_alleles_raise(spark, alt):
    with pytest.raises(Exception, match="symbolic"):
        one(spark, G.infer_type(F.lit("A"), F.lit(alt)))


def test_variant_ids(spark):
    assert [one(spark, G.variant_id(F.lit(r), F.lit(a))) for r, a in [(None, None), ("A", "C"), ("ATC", ""), ("", "ABC")]] == ["", "A_C", "ATC_", "_ABC"]
    assert tuple(one(spark, G.parse_id(F.lit("_ABC")))) == ("", "ABC")


@pytest.mark.parametrize(("start", "end", "want"), [(97, 99, False), (97, 100, True), (98, 101, True), (99, 100, True), (101, 102, False), (100, 99, True)])
def test_insertion_overlap(spark, start, end, want):
    assert one(spark, I.overlaps(F.lit(100), F.lit(99), F.lit(start), F.lit(end), True)) is want
    assert one(spark, I.overlaps(F.lit(100), F.lit(99), F.lit(99), F.lit(99))) is True


def test_region_text():
    assert parse_region("10:123-432") == ("10", 123, 432)
    with pytest.raises(ValueError, match="not a region"):
        parse_region("10-5")


@pytest.mark.parametrize(("aa", "ab", "bb", "want"), [(1, 2, 1, 1.0), (0, 10, 90, 1.0), (5, 10, 85, 0.0010086749690570533), (2, 2, 2, 0.8225108225108225), (10, 0, 10, 2.6806043152708522e-06), (25, 50, 25, 1.0), (0, 100, 0, 2.799936818494868e-29), (0, 0, 0, -1.0), (0, 0, 7, 1.0)])
def test_hardy_weinberg(spark, aa, ab, bb, want):
    assert one(spark, exact_p(F.lit(aa), F.lit(ab), F.lit(bb))) == pytest.approx(want, rel=1e-9)
    assert one(spark, exact_p(F.lit(bb), F.lit(ab), F.lit(aa))) == pytest.approx(want, rel=1e-9)


def test_hardy_weinberg_far_tail(spark):
    assert 0 <= one(spark, exact_p(F.lit(3000), F.lit(0), F.lit(3000))) < 1e-300


def calls(spark, *rows):
    full = [(s, s, "1", a, b, ref, alt, kind, [x for x in [sec] if x], gt, 30, [1, 2], None) for s, a, b, ref, alt, kind, sec, gt in rows]
    return spark.createDataFrame(full, CALL)


A_, B_, C_, D_, E_, F_, G_ = 1, 2, 3, 4, 5, 6, 7


def seven(spark):
    sec = (13, 13, "A", "G", "SNV")
    return calls(
        spark,
        (A_, 13, 13, "A", "T", "SNV", None, "0/1"),
        (B_, 9, 21, "", "", "NO_VARIATION", None, "0/0"),
        (C_, 14, 13, "", "AGC", "INDEL", None, "0/1"),
        (C_, 13, 13, "A", "G", "SNV", None, "0/1"),
        (D_, 13, 15, "AGC", "", "INDEL", None, "0/1"),
        (E_, 11, 18, "", "", "NO_VARIATION", None, "./."),
        (F_, 13, 13, "A", "G", "SNV", None, "1/1"),
        (G_, 13, 13, "A", "T", "SNV", sec, "1/2"),
    )


def merged_seven(spark):
    rows = R.call_regions(seven(spark))
    gaps = R.no_call_gaps(rows, rows.select("sample_id", "chrom").distinct(), 10, 21)
    filled = gaps.select("sample_id", "chrom", "start", "end", F.lit("NOCALL").alias("kind"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("string").alias("alt"), F.lit("NO_VARIATION").alias("type"), F.lit(1).alias("allele_count"), F.lit(0).alias("depth"), F.lit(False).alias("pass"))
    return M.merge(rows.unionByName(filled), width=8)


def test_seven_samples(spark):
    got = {}
    for r in M.slots(merged_seven(spark)).where("slot <> 'F'").collect():
        got.setdefault((r.pos, r.ref, r.alt), {}).setdefault((r.slot, r.allele), set()).add(r.sample_id)
    assert got[13, "A", "T"] == {("V", 1): {A_, G_}, ("R", 1): {A_, C_, D_}, ("R", -1): {E_}, ("G", 1): {C_, G_}, ("G", 2): {F_}, ("*", 1): {D_}}
    assert got[13, "A", "G"] == {("V", 1): {C_, G_}, ("V", 2): {F_}, ("R", 1): {A_, C_, D_}, ("R", -1): {E_}, ("T", 1): {A_, G_}, ("*", 1): {D_}}
    assert got[13, "AGC", ""] == {("V", 1): {D_}, ("R", 1): {D_}, ("R", -1): {E_}}
    assert got[14, "", "AGC"] == {("V", 1): {C_}, ("R", 1): {C_, D_}, ("R", -1): {E_, A_, F_, G_}, ("*", 1): {D_}}


COMBINE = "type string, alt string, a int, r int, ri int, nc boolean, b_A int, b_C int, b_T int, b_G int, d int, n int, o int"


@pytest.mark.parametrize(
    ("row", "reference", "deleted", "inserted"),
    [
        (("DELETION", "", 1, 1, None, False, 0, 0, 0, 0, 1, 0, 1), 1, None, None),  # alone
        (("DELETION", "", 0, 1, None, False, 0, 0, 0, 0, 1, 0, 1), 1, 1, None),  # a longer one covers it
        (("DELETION", "", 0, 1, None, False, 0, 0, 0, 0, 1, 0, 0), None, None, None),  # a shorter one doesn't: 1 + 1 is hom-ref
        (("INSERTION", "G", 1, 0, 1, False, 0, 0, 0, 0, 0, 1, 1), 1, None, None),
        (("INSERTION", "G", 0, 1, None, False, 0, 0, 0, 1, 0, 0, 0), None, None, None),  # an SNV beside it: hom-ref
        (("INSERTION", "GTT", 0, 0, 1, False, 0, 0, 0, 0, 0, 1, 1), 1, None, 1),  # another insertion
        (("SNV", "G", 1, 1, None, False, 0, 0, 0, 1, 0, 0, 0), 1, None, None),
        (("SNV", "G", 0, 2, None, False, 0, 0, 0, 0, 0, 0, 0), None, None, None),
        (("SNV", "G", 0, 1, None, False, 0, 0, 0, 0, 0, 0, 0), 1, None, None),  # haploid
        (("SNV", "G", 0, 0, None, True, 0, 0, 0, 0, 0, 0, 0), -1, None, None),
    ],
)
def test_combine(spark, row, reference, deleted, inserted):
    got = M.combine(spark.createDataFrame([row], COMBINE)).first()
    assert (got.reference, got.sec_del, got.sec_ins) == (reference, deleted, inserted)


def test_genotype_classes(spark):
    """het 1 2, hom-alt 3, haploid 6 and 8, no-call 7, with other bases 10 to 12, with a deletion 20; the rest hom-ref."""
    none = dict.fromkeys(["reference", *M.SECONDS])
    of = {7: {"reference": -1}, 1: {"reference": 1, "a": 1}, 2: {"reference": 1, "a": 1}, 5: {"reference": 1, "a": 1}, 6: {"reference": 1}, 8: {"a": 1}, 12: {"a": 1, "sec_G": 1}, 3: {"a": 2}, 10: {"reference": 1, "sec_G": 1}, 11: {"sec_G": 2}, 20: {"reference": 1, "sec_del": 1}, 21: {"sec_ins": 2}}
    rows = [(s, "1", 100, "A", "T", "SNV", v.get("a", 0), *((none | v)[c] for c in ("reference", *M.SECONDS)), False) for s, v in of.items()]
    names = ", ".join(f"{c} int" for c in ("reference", *M.SECONDS))
    merged = spark.createDataFrame(rows, f"sample_id int, chrom string, pos int, ref string, alt string, type string, a int, {names}, not_pass boolean")
    got = GT.sample_genotypes(merged)
    by = {r.sample_id: r.gt for r in got.collect()}
    assert by == {1: "0/1", 2: "0/1", 5: "0/1", 3: "1/1", 6: "0", 8: "1", 7: ".", 10: "0/2", 11: "2/2", 12: "1/2", 20: "0/3", 21: "0/0"}
    cohort = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 6, 7, 8, 10, 11, 12, 20, 21)], "sample_id int")
    c = GT.genotype_classes(got, cohort).first()
    assert (c.het, c.hom_alt, c.no_call, c.hom_ref_count) == ([1, 2], [3], [7], 2)
    assert c.other == {"0": [6], "1": [8], "0/2": [10], "2/2": [11], "1/2": [12], "0/3": [20]}
    assert c.alleles == ["A", "T", "G", "*"]


def test_haploid_statistics(spark):
    rows = [(1, "Y", 123, "A", "G", "SNV", 1, None, *[None] * 6, False), (2, "Y", 123, "A", "G", "SNV", 0, 1, *[None] * 6, False)]
    names = ", ".join(f"{c} int" for c in ("reference", *M.SECONDS))
    merged = spark.createDataFrame(rows, f"sample_id int, chrom string, pos int, ref string, alt string, type string, a int, {names}, not_pass boolean")
    s = stats.cohort_statistics(merged, spark.createDataFrame([("c", 1), ("c", 2)], "cohort string, sample_id int")).first()
    assert (s.ref_ac, s.alt_ac, s.maf) == (1, 1, 0.5)


def tiled(spark, kind, start, end):
    rows = spark.createDataFrame([("1", start, end, kind)], "chrom string, start int, end int, kind string")
    return sorted((r.start, r.end) for r in R.tiles(rows, 2, 10, 19).collect())


@pytest.mark.parametrize(("start", "end", "kept"), [(10, 10, 1), (19, 19, 1), (9, 9, 0), (20, 20, 0), (10, 9, 1), (12, 11, 1), (19, 18, 1), (9, 8, 0), (20, 19, 0), (5, 10, 1), (9, 12, 1), (9, 21, 1), (17, 19, 1), (19, 22, 1), (5, 9, 0)])
def test_tiles_keep_variation_once(spark, start, end, kept):
    assert tiled(spark, "VAR", start, end) == [(start, end)] * kept


def test_tiles_cut_blocks(spark):
    rows = spark.createDataFrame([("1", 1090, 1110, "REF")], "chrom string, start int, end int, kind string")
    assert sorted((r.start, r.end) for r in R.tiles(rows, 100, 1000, 1999).collect()) == [(1090, 1099), (1100, 1110)]


def test_no_call_gap_cover_the_window_once(spark):
    rows = spark.createDataFrame([(1, "1", 100, 101), (1, "1", 105, 104), (2, "1", 99, 102)], "sample_id int, chrom string, start int, end int")
    got = R.no_call_gaps(rows, rows.select("sample_id", "chrom").distinct(), 99, 103)
    assert sorted(map(tuple, got.collect())) == [(1, "1", 99, 99), (1, "1", 102, 102)]
    from_zero = R.no_call_gaps(rows.where("start > 500"), rows.select("sample_id", "chrom").distinct(), 0, 3)
    assert sorted(map(tuple, from_zero.collect())) == [(1, "1", 0, 2), (2, "1", 0, 2)]


def test_append_doubles_lists(spark):
    counts = spark.createDataFrame([("1", 1, "A", "T", "V", 1, 7)], schema("variant_counts"))
    assert M.append_counts(counts, counts).count() == 2


def test_bin_width_does_not_matter(spark):
    rows = R.call_regions(seven(spark))
    a, b = (sorted(map(str, M.slots(M.merge(rows, width=w)).collect())) for w in (1, 1000))
    assert a == b


def test_schemas_parse():
    assert all(schema(n).fields for n in NAMES)


def test_missing_alternate_index_raises(spark):
    with pytest.raises(Exception, match="unsupported type"):
        R.allele_records(calls(spark, (1, 5, 5, "A", "C", "SYMBOLIC", None, "0/1"))).collect()
