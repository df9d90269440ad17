"""Merging region rows into per-sample variant states, and states into variant rows.

A variant's result for a sample depends on that sample's own numbers at the position
only, so the merge is one interval join, one aggregate and column rules: no ordered sweep
and no state. Plain hom-ref rows say nothing that subtraction doesn't, so they go before
the join; the join's bins also partition the aggregate and what follows by variant.

Numbers per (variant, sample): ``a`` own alternate count, ``r`` reference count, ``nc``
no-call, ``ri`` reference count of an insertion, ``b_X`` counts of the SNV alternates,
``d`` deletion and ``n`` insertion count at the position, ``o`` count of the variants
that cover this one wholly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions import genotype as G

from .joins import binned_points, dealt, point_in_range, small

BASES = ("A", "C", "T", "G")
POINT = ["chrom", "pos"]
VARIANT = ["chrom", "pos", "ref", "alt"]


def variant_samples(regions: DataFrame) -> DataFrame:
    """Alternate count per variant and sample: repeated entries of a sample add up."""
    own = regions.where("kind = 'VAR'").select("chrom", F.col("start").alias("pos"), "ref", "alt", "sample_id", "allele_count")
    return own.groupBy(*VARIANT, "sample_id").agg(F.sum("allele_count").cast("int").alias("a"))


def plain_reference() -> Column:
    """Rows of two reference alleles that pass: hom-ref, derived by subtraction. An insertion's reference row isn't."""
    return (F.col("kind") == "REF") & (F.col("allele_count") == 2) & F.col("pass") & (F.col("type") != "INSERTION")


def _state_columns() -> list[Column]:
    """Aggregates over a sample's rows at a point."""
    n = F.col("allele_count")
    ref, var, kind = F.col("kind") == "REF", F.col("kind") == "VAR", F.col("type")
    total = lambda when: F.sum(F.when(when, n).otherwise(0)).cast("int")
    # a single reference entry of two is hom-ref and isn't kept; entries of other counts add up
    return [
        total(ref & (kind != "INSERTION") & (n != 2)).alias("r"),
        F.sum(F.when(ref & (kind == "INSERTION"), n)).cast("int").alias("ri"),
        F.max(F.col("kind") == "NOCALL").alias("nc"),
        *(total(var & (kind == "SNV") & (F.col("alt") == x)).alias(f"b_{x}") for x in BASES),
        total(var & kind.isin("DELETION", "MNV", "MIXED")).alias("d"),
        total(var & (kind == "INSERTION")).alias("n"),
        F.max(~F.col("pass")).alias("not_pass"),
    ]


def position_states(points: DataFrame, regions: DataFrame, width: int = 128) -> DataFrame:
    """What each sample has at each point (chrom, pos): r, ri, nc, b_X, d, n, not_pass."""
    return point_in_range(points, regions, width).groupBy(*POINT, "sample_id").agg(*_state_columns())


def covering(variants: DataFrame, regions: DataFrame, width: int = 128) -> DataFrame:
    """Per variant (chrom, pos, ref, alt) and sample the count ``o`` of non-SNV variants that cover it wholly.

    An insertion is covered by the insertions at its position, another variant by those
    that hold its start and end at its end or later.
    """
    wide = regions.where("kind = 'VAR' AND type <> 'SNV'").select("chrom", "start", "end", "sample_id", "allele_count")
    wanted = variants.select(*VARIANT).withColumn("v_end", G.end_of(F.col("pos"), F.col("ref"))).where("NOT (length(ref) = 1 AND length(alt) = 1)")
    met = point_in_range(wanted, wide, width)
    whole = F.when(F.col("v_end") < F.col("pos"), F.col("end") == F.col("v_end")).otherwise(F.col("end") >= F.col("v_end"))
    return met.where(whole).groupBy(*VARIANT, "sample_id").agg(F.sum("allele_count").cast("int").alias("o"))


def _apart(rows: DataFrame) -> DataFrame:
    """``rows``, where Spark ends a generated method and moves no filter or rule over the end.

    The rules make a method too large to compile, which would take the join and the
    aggregate before them and the entries after them along to the interpreter. A
    higher-order function isn't part of such a method.
    """
    end = F.exists(F.array(F.monotonically_increasing_id()), lambda x: x < 0)
    return rows.withColumn("_end", end).where("NOT _end").drop("_end")


def _positive(x: Column) -> Column:
    return F.when(x > 0, x)


SECONDS = (*(f"sec_{x}" for x in BASES), "sec_del", "sec_ins")


def combine(rows: DataFrame) -> DataFrame:
    """Rows of a sample's numbers at a variant (type, alt, a, r, ri, nc, b_X, d, n, o) with its results.

    ``reference``: 1 or more, -1 for no-call, null for hom-ref (an entry of 2 isn't
    stored); ``sec_X`` per base, ``sec_del`` and ``sec_ins``: counts or null. In steps, so
    that no sum is written out twice.
    """
    c = F.col
    zero = {x: F.coalesce(x, F.lit(0)) for x in ("a", "r", "d", "n", "o", *(f"b_{x}" for x in BASES))}
    rows = rows.withColumns(zero | {"ri": c("ri").cast("int"), "nc": F.coalesce("nc", F.lit(False))})
    bases = sum((c(f"b_{x}") for x in BASES), F.lit(0))
    rows = rows.withColumns({"_bases": bases, "_more": F.greatest(c("o") - c("a"), F.lit(0))})
    # bases join an insertion's reference where the sample has nothing inserted; else the first one stands in for a missing entry
    free = F.when(c("ri").isNotNull() | (c("_bases") > 0), F.coalesce("ri", F.lit(0)) + c("_bases"))
    kept = F.when((c("a") == 0) & (c("n") == 0), free).otherwise(F.coalesce("ri", *(_positive(c(f"b_{x}")) for x in BASES)))
    rows = rows.withColumns({"_base": F.when(c("o") == 0, c("d")).otherwise(0) + c("_bases"), "_kept": kept})
    gains = (c("n") > 0) & (c("r") == 0) & (((c("a") > 0) & (c("_base") == 0)) | ((c("a") == 0) & (c("d") > 0)))
    rows = rows.withColumns({"_whole": c("_base") + c("r") + F.when(gains, c("n")).otherwise(0), "_kept": F.when(c("_kept").isNull() & c("nc"), -1).otherwise(c("_kept"))})
    snv = F.when(c("r") > 0, c("r")).when(c("nc"), -1)
    deletion = F.when(c("_whole") > 0, c("_whole")).when(c("nc"), -1)
    added = F.when(c("_kept") == -1, c("r")).otherwise(c("_kept") + c("r"))
    insertion = F.when(c("r") > 0, F.when(c("_kept").isNull(), c("r")).when((c("a") == 0) & (c("_more") == 0), added).otherwise(c("_kept"))).otherwise(c("_kept"))
    is_snv, is_ins = c("type") == "SNV", c("type") == "INSERTION"
    rows = rows.withColumn("_entry", F.when(is_snv, snv).when(is_ins, insertion).otherwise(deletion))
    out = {"reference": F.when(c("_entry") != 2, c("_entry")).cast("int")}
    for x in BASES:
        out[f"sec_{x}"] = F.when(is_snv & (c("alt") != x), _positive(c(f"b_{x}")))
    out["sec_del"] = F.when(is_snv | is_ins, _positive(c("d"))).otherwise(_positive(c("_more")))
    out["sec_ins"] = F.when(is_snv, _positive(c("n"))).when(is_ins, _positive(c("_more")))
    return rows.withColumns(out)


def variant_keys(regions: DataFrame) -> DataFrame:
    """The distinct variants of region rows."""
    return regions.where("kind = 'VAR'").select("chrom", F.col("start").alias("pos"), "ref", "alt").distinct()


def numbers(regions: DataFrame, width: int = 128, variants: DataFrame | None = None, span: int | None = None, parts: int | None = None) -> DataFrame:
    """All numbers of every (variant, sample) that has a row at the variant's position, with the position's bin.

    Every row that a sample has at a position meets every variant there (all of
    ``regions``, or ``variants``), so one aggregate finds the sample's own counts, what
    covers the variant and the state together; its groups lie within a bin, so the join's
    partitions serve it as they are. ``span``: see ``dealt``; with ``parts`` the rows meet
    in so many partitions by chromosome and stretch (by chromosome and bin without
    ``span``), and stay there. Rows that have ``fresh_only`` set meet only the variants
    that have ``fresh`` set.
    """
    at = variant_keys(regions) if variants is None else variants
    told = "fresh_only" in regions.columns
    at = binned_points(at.groupBy(*POINT).agg(F.collect_set(F.struct("ref", "alt", *(["fresh"] if told else []))).alias("here")), width)
    rows = regions.select("chrom", "start", "end", "kind", F.col("ref").alias("r_ref"), "alt", "type", "allele_count", "pass", "sample_id", *(["span"] if span else []), *(["fresh_only"] if told else []))
    rows = dealt(rows, width, at.select("chrom", "_bin"), span)
    on = ["chrom", "_bin"]
    if span and parts:
        on = ["chrom", "span", "_bin"]
        at = at.withColumn("span", F.floor(F.col("pos") / span).cast("int")).repartition(parts, "chrom", "span")
        rows = rows.repartition(parts, "chrom", "span")
    elif parts:
        at, rows = at.repartition(parts, *on), rows.repartition(parts, *on)
    met = at.join(rows, on).where((F.col("start") <= F.col("pos")) & (F.col("pos") <= F.greatest("start", "end")))
    each = met.withColumn("v", F.explode("here")).withColumn("v_end", G.end_of(F.col("pos"), F.col("v.ref")))
    each = each.where("v.fresh OR NOT fresh_only") if told else each
    var, n = F.col("kind") == "VAR", F.col("allele_count")
    own = var & (F.col("start") == F.col("pos")) & (F.col("r_ref") == F.col("v.ref")) & (F.col("alt") == F.col("v.alt"))
    whole = F.when(F.col("v_end") < F.col("pos"), F.col("end") == F.col("v_end")).otherwise(F.col("end") >= F.col("v_end"))
    over = var & (F.col("type") != "SNV") & whole & ~((F.length("v.ref") == 1) & (F.length("v.alt") == 1))
    keys = [*on, "pos", F.col("v.ref").alias("ref"), F.col("v.alt").alias("v_alt"), "sample_id"]
    total = lambda when: F.sum(F.when(when, n)).cast("int")
    return each.groupBy(*keys).agg(total(own).alias("a"), total(over).alias("o"), *_state_columns()).withColumnRenamed("v_alt", "alt")


def merge(regions: DataFrame, indexed: DataFrame | None = None, width: int = 128, keep_bin: bool = False, variants: DataFrame | None = None, span: int | None = None, parts: int | None = None) -> DataFrame:
    """Region rows to merged variants, long: one row per variant and sample that is not plainly hom-ref.

    chrom, pos, ref, alt, type, sample_id, a, reference, sec_A .. sec_ins, not_pass
    (only of ``indexed`` samples if given). A variant is emitted at its own start only.
    ``keep_bin`` leaves the bin (``_bin``) by which the rows are partitioned. ``variants``:
    the variants to look at instead of all that the rows have. ``span``, ``parts``: see ``numbers``.
    """
    rows = _apart(numbers(regions.where(~plain_reference()), width, variants, span, parts)).withColumn("type", G.type_of_id(F.col("ref"), F.col("alt")))
    if indexed is not None:
        rows = rows.join(small(indexed.select("sample_id", F.lit(True).alias("_indexed"))), "sample_id", "left").withColumn("not_pass", F.col("not_pass") & F.coalesce("_indexed", F.lit(False)))
    done = combine(rows).select(*(["_bin"] if keep_bin else []), *VARIANT, "type", "sample_id", "a", "reference", *SECONDS, "not_pass")
    any_ = " OR ".join(f"{x} IS NOT NULL" for x in ("reference", *SECONDS))
    return _apart(done).where(f"a > 0 OR not_pass OR {any_}")


def by_variant(merged: DataFrame) -> list[str]:
    """The keys that group merged rows by variant, the bin among them if it is there."""
    return [*(["_bin"] if "_bin" in merged.columns else []), *VARIANT]


def slots(merged: DataFrame) -> DataFrame:
    """Merged rows as the long count table: chrom, pos, ref, alt, slot, allele, sample_id."""
    entry = lambda slot, n: F.struct(F.lit(slot).alias("slot"), n.cast("int").alias("allele"))
    entries = [entry("R", F.col("reference")), entry("V", _positive(F.col("a"))), *(entry(x, F.col(f"sec_{x}")) for x in BASES), entry("*", F.col("sec_del")), entry("+", F.col("sec_ins")), entry("F", F.when(F.col("not_pass"), 0))]
    each = merged.select(*VARIANT, "sample_id", F.inline(F.array(*entries)))
    return each.where("allele IS NOT NULL").select(*VARIANT, "slot", "allele", "sample_id")


def sample_lists(counts: DataFrame) -> DataFrame:
    """The count table with one row per slot and allele: its distinct samples, ascending."""
    return counts.groupBy(*VARIANT, "slot", "allele").agg(F.array_sort(F.collect_set("sample_id")).alias("sample_ids"))


def append_counts(*batches: DataFrame) -> DataFrame:
    """Loads appended: lists are concatenated, nothing is merged."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b)
    return out
