"""Call records to region rows: one row per sample, interval and allele."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.functions import genotype as G
from cohortspark.functions import intervals as I

BIN = 1000
REFERENCE, NO_CALL, VARIATION = "REF", "NOCALL", "VAR"


def file_scan(calls: DataFrame, file_ids: list[int]) -> DataFrame:
    """Records of the given files."""
    return calls.where(F.col("file_id").isin(*file_ids))


def region_scan(rows: DataFrame, chrom: str, start: int, end: int, pos: str = "start") -> DataFrame:
    """Rows that begin in a region, its end excluded."""
    return rows.where((F.col("chrom") == chrom) & (F.col(pos) >= start) & (F.col(pos) < end))


def fixed_end(calls: DataFrame, off_by_one: bool = False) -> DataFrame:
    """Reference blocks with their end one lower, where a caller wrote it one too high, and never before the start."""
    end = F.greatest(F.col("end") - (1 if off_by_one else 0), F.col("start"))
    return calls.withColumn("end", F.when(F.col("type") == "NO_VARIATION", end).otherwise(F.col("end")))


def touching(calls: DataFrame, start: int, following: int) -> DataFrame:
    """Records that touch a slice."""
    return calls.where((F.col("start") <= following) & (F.col("end") >= start))


def allele_records(calls: DataFrame) -> DataFrame:
    """One row per record and allele: its own coordinates, type, count and depth."""
    base = calls.withColumn("counts", G.allele_counts(F.col("gt")))
    rows = base.select("*", F.explode("counts").alias("allele", "allele_count"))
    second = F.get(F.col("sec_alts"), F.col("allele") - 2)
    main = F.col("allele") < 2
    of = lambda c: F.when(main, F.col(c)).otherwise(second[c])
    start, end = of("start"), of("end")
    kind = G.stored_type(of("type"))
    kind = F.when(kind == "INDEL", F.when(start > end, "INSERTION").otherwise("DELETION")).otherwise(kind)
    return rows.select(
        "sample_id",
        "chrom",
        F.col("start").alias("main_start"),
        F.col("end").alias("main_end"),
        "counts",
        "allele",
        "allele_count",
        start.alias("start"),
        end.alias("end"),
        F.when(F.col("allele") > 0, of("ref")).alias("ref"),
        F.when(F.col("allele") > 0, of("alt")).alias("alt"),
        kind.alias("type"),
        G.depth(F.col("allele"), F.col("ad"), F.col("dp")).alias("depth"),
        G.is_pass(F.col("filter")).alias("pass"),
        F.col("type").alias("main_type"),
    )


def fill_rows(alleles: DataFrame) -> DataFrame:
    """Reference rows that second alternates imply beside the positions they cover.

    Apart from the main record: over that record if its alternate was called, and over the
    second alternate. Across it: over the ends that only one of the two covers.
    """
    a = alleles.where("allele >= 2")
    fill = F.coalesce(F.try_element_at("counts", F.lit(0)), F.lit(0)) + 2 - F.col("allele_count")
    s, e, ms, me = F.col("start"), F.col("end"), F.col("main_start"), F.col("main_end")
    top, mtop = F.greatest(s, e), F.greatest(ms, me)
    row = lambda start, end, kind: F.struct(start.alias("start"), end.alias("end"), kind.alias("type"))
    first_type = F.when(ms > me, "INSERTION").when(F.col("main_type").isin("INDEL", "SV"), "DELETION").otherwise(F.col("main_type"))
    apart = F.array(F.when(F.map_contains_key("counts", F.lit(1)), row(ms, me, first_type)), row(s, e, F.col("type")))
    across = F.array(
        F.when(s != ms, row(F.least(s, ms), F.greatest(s, ms) - 1, F.lit("DELETION"))),
        F.when(top != mtop, row(F.least(top, mtop) + 1, F.greatest(top, mtop), F.lit("DELETION"))),
    )
    rows = F.filter(F.when(I.overlaps(s, e, ms, me, True), across).otherwise(apart), lambda x: x.isNotNull())
    out = a.select("sample_id", "chrom", "depth", "pass", fill.alias("allele_count"), F.explode(rows).alias("x"))
    return out.select("sample_id", "chrom", F.col("x.start").alias("start"), F.col("x.end").alias("end"), F.lit(REFERENCE).alias("kind"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("string").alias("alt"), F.col("x.type").alias("type"), "allele_count", "depth", "pass")


def call_regions(calls: DataFrame) -> DataFrame:
    """All region rows of the records: reference, no-call and variation, and implied reference rows."""
    a = allele_records(calls)
    kind = F.when(F.col("allele") < 0, NO_CALL).when(F.col("allele") == 0, REFERENCE).otherwise(VARIATION)
    own = a.select("sample_id", "chrom", "start", "end", kind.alias("kind"), "ref", "alt", "type", "allele_count", "depth", "pass")
    return own.unionByName(fill_rows(a))


def within(regions: DataFrame, low: int, high: int) -> DataFrame:
    """Rows that meet a window (an insertion only at its start), blocks clipped to it."""
    met = I.overlaps(F.col("start"), F.col("end"), F.lit(low), F.lit(high), True)
    block = F.col("kind") != VARIATION
    start, end = I.clip(F.col("start"), F.col("end"), low, high)
    return regions.where(met).withColumns({"start": F.when(block, start).otherwise(F.col("start")), "end": F.when(block & (F.col("start") <= F.col("end")), end).otherwise(F.col("end"))})


def binned(rows: DataFrame, width: int = BIN, start: str = "start", end: str = "end", name: str = "bin") -> DataFrame:
    """One row per bin that an interval touches."""
    return rows.withColumn(name, F.explode(I.bins(F.col(start), F.col(end), width)))


def home_bin(rows: DataFrame, width: int = BIN, start: str = "start", bin_column: str = "bin") -> DataFrame:
    """Of a row that was written to several bins, the copy in the bin of its start."""
    return rows.where(F.col(bin_column) == F.floor(F.least(F.col(start), F.col("end")) / width).cast("int"))


def tiles(rows: DataFrame, width: int, low: int, high: int) -> DataFrame:
    """Rows cut into tiles of a window: blocks are clipped to each tile, variation is kept whole in the tile of its start."""
    met = rows.where(I.overlaps(F.col("start"), F.col("end"), F.lit(low), F.lit(high), True))
    s, e = F.greatest(F.least("start", "end"), F.lit(low)), F.least(F.greatest("start", "end"), F.lit(high))
    cut = met.withColumn("tile", F.explode(F.when(F.col("kind") == VARIATION, F.array(F.floor(F.greatest(F.col("start"), F.lit(low)) / width).cast("int"))).otherwise(I.bins(s, e, width))))
    block = F.col("kind") != VARIATION
    start = F.greatest(F.col("start"), F.lit(low), F.col("tile") * width)
    end = F.least(F.col("end"), F.lit(high), (F.col("tile") + 1) * width - 1)
    return cut.withColumns({"start": F.when(block, start).otherwise(F.col("start")), "end": F.when(block, end).otherwise(F.col("end"))})


def no_call_gaps(regions: DataFrame, samples: DataFrame, low: int | Column, high: int | Column, keys: tuple[str, ...] = ("sample_id", "chrom")) -> DataFrame:
    """Per sample and chromosome the maximal runs of [low, high) that no row covers, ends included.

    Gaps and islands: a running maximum of the covered ends shows where the next row leaves
    a hole. ``samples`` (the keys) brings in those without any row.
    """
    low, high = F.lit(low), F.lit(high)
    s, e = F.greatest(F.least("start", "end"), low), F.least(F.greatest("start", "end"), high - 1)
    covered = regions.where(F.col("start") <= F.col("end")).select(*keys, s.alias("s"), e.alias("e")).where("s <= e")
    ends = samples.select(*keys, high.alias("s"), high.alias("e"))
    w = W.partitionBy(*keys).orderBy("s", "e").rowsBetween(W.unboundedPreceding, -1)
    run = covered.unionByName(ends).withColumn("upto", F.coalesce(F.max("e").over(w), low - 1))
    return run.where(F.col("s") > F.col("upto") + 1).select(*keys, (F.col("upto") + 1).alias("start"), (F.col("s") - 1).alias("end"))


def positional(regions: DataFrame) -> DataFrame:
    """One row per position of each interval (an insertion at its start): the older, wider form."""
    return regions.withColumn("pos", F.explode(F.sequence("start", F.greatest("start", "end"))))
