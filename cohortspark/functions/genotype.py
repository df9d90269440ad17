"""Genotype strings, allele records and variant ids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_CALL = -1


#: Allele counts of the genotypes that most records have, which are looked up instead of parsed.
USUAL_COUNTS = {
    "./.": (NO_CALL, 1),
    ".": (NO_CALL, 1),
    "0": (0, 1),
    "1": (1, 1),
    "0/0": (0, 2),
    "1/1": (1, 2),
    **{gt: (0, 1, 1, 1) for gt in ("0/1", "0|1", "1|0")},
    "0/2": (0, 1, 2, 1),
    "1/2": (1, 1, 2, 1),
}


def alleles(gt: Column) -> Column:
    """Allele numbers of a genotype string, a dot as NO_CALL."""
    return F.transform(F.split(gt, r"[/|]"), lambda x: F.when(x == ".", F.lit(NO_CALL)).otherwise(x.try_cast("int")))


def allele_counts(gt: Column) -> Column:
    """Map of allele number to its count. NO_CALL goes if any allele was called, else counts once."""

    def of(called: Column) -> Column:
        distinct = F.array_sort(F.array_distinct(called))
        return F.map_from_arrays(distinct, F.transform(distinct, lambda a: F.size(F.filter(called, lambda x: x == a))))

    none = F.create_map(F.lit(NO_CALL), F.lit(1))
    called = F.filter(alleles(gt), lambda x: x >= 0)
    parsed = F.when(F.size(called) == 0, none).otherwise(of(called))
    usual = F.create_map(*(F.lit(x) if isinstance(x, str) else F.create_map(*map(F.lit, x)) for kv in USUAL_COUNTS.items() for x in kv))
    return F.coalesce(F.try_element_at(usual, gt), parsed)


def depth(allele: Column, ad: Column, dp: Column) -> Column:
    """Depth of an allele: its entry in ``ad``, else the record's, else -1."""
    return F.coalesce(F.when(allele >= 0, F.get(ad, allele)), dp, F.lit(-1))


def is_pass(filters: Column) -> Column:
    return F.coalesce(filters, F.lit(".")) == "PASS"


def infer_type(ref: Column, alt: Column) -> Column:
    """Variant type from allele lengths, a dot as empty; symbolic alleles raise."""
    r, a = (F.when(x == ".", F.lit("")).otherwise(x) for x in (ref, alt))
    symbolic = r.rlike(r"[<>\[\].]") | a.rlike(r"[<>\[\].]")
    n, m = F.length(r), F.length(a)
    return (
        F.when(symbolic, F.raise_error(F.concat(F.lit("symbolic allele: "), ref, F.lit(" "), alt)).cast("string"))
        .when((n == 0) & (m == 0), "NO_VARIATION")
        .when(n == m, F.when(n == 1, "SNV").otherwise("MNV"))
        .when(n == 0, "INSERTION")
        .when(m == 0, "DELETION")
        .otherwise("MIXED")
    )


def type_of_id(ref: Column, alt: Column) -> Column:
    """Variant type from an id's two alleles; never MIXED."""
    return F.when(F.length(ref) == F.length(alt), F.when(F.length(ref) > 1, "MNV").otherwise("SNV")).when(F.length(ref) == 0, "INSERTION").otherwise("DELETION")


def end_of(pos: Column, ref: Column) -> Column:
    return pos + F.length(ref) - 1


def variant_id(ref: Column, alt: Column) -> Column:
    """``ref_alt``, or nothing for a reference record."""
    return F.when(ref.isNull() & alt.isNull(), F.lit("")).otherwise(F.concat(F.coalesce(ref, F.lit("")), F.lit("_"), F.coalesce(alt, F.lit(""))))


def parse_id(vid: Column) -> Column:
    """An id's (ref, alt)."""
    parts = F.split(vid, "_", 2)
    return F.struct(F.get(parts, F.lit(0)).alias("ref"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("alt"))


#: Types a record may have, and what they are stored as.
STORED_TYPE = {"SNV": "SNV", "SNP": "SNV", "MNV": "MNV", "MNP": "MNV", "INDEL": "INDEL", "SV": "INDEL", "MIXED": "MIXED", "NO_VARIATION": "NO_VARIATION"}


def stored_type(kind: Column) -> Column:
    """The type under which a record is stored; others raise."""
    found = F.element_at(F.create_map(*(F.lit(x) for kv in STORED_TYPE.items() for x in kv)), kind)
    return F.coalesce(found, F.raise_error(F.concat(F.lit("unsupported type: "), F.coalesce(kind, F.lit("null")))).cast("string"))


def normalise(ref: Column, alt: Column, pos: Column) -> Column:
    """Upper-cased alleles without one shared leading base, with start and end to match."""
    r, a = F.upper(F.trim(ref)), F.upper(F.trim(alt))
    shared = (F.length(r) > 0) & (F.length(a) > 0) & (F.substring(r, 1, 1) == F.substring(a, 1, 1))
    cut = lambda x: F.when(shared, x.substr(F.lit(2), F.length(x))).otherwise(x)
    start = F.when(shared, pos + 1).otherwise(pos)
    return F.struct(cut(r).alias("ref"), cut(a).alias("alt"), start.alias("start"), (start + F.length(cut(r)) - 1).alias("end"))


def decimal(x: Column, digits: int) -> Column:
    """A number as ``#.###``: half-even rounding, no trailing zeros."""
    text = F.format_string(f"%.{digits}f", F.bround(x.cast("double"), digits))
    return F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
