"""The variant query: options are gathered and turned into one DataFrame plan."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from cohortspark.operators import filters
from cohortspark.sources.readers import parse_region


class VariantQuery:
    """Builder over a table of variants; each call narrows the query and returns it.

    ``table`` has chrom, pos, ref, alt, type; cohort columns are named ``<cohort>_opr`` and
    so on. Genotypes are tested on the long count table ``counts``, or else on the
    table's slot lists.
    """

    def __init__(self, table: DataFrame, counts: DataFrame | None = None) -> None:
        self.table, self.counts = table, counts
        self._where: list[Column] = []
        self._columns: Sequence[str] | None = None
        self._order: Sequence[str] = ()
        self._limit: int | None = None
        self._skip = 0

    def where(self, test: Column) -> VariantQuery:
        self._where.append(test)
        return self

    def region(self, *texts: str) -> VariantQuery:
        """Any of the regions, their ends included."""
        tests = []
        for t in texts:
            c, s, e = parse_region(t)
            tests.append((F.col("chrom") == c) & F.col("pos").between(s, e))
        test = tests[0]
        for t in tests[1:]:
            test = test | t
        return self.where(test)

    def reference(self, *alleles: str) -> VariantQuery:
        return self.where(F.col("ref").isin(*alleles))

    def alternate(self, *alleles: str) -> VariantQuery:
        return self.where(F.col("alt").isin(*alleles))

    #: Types that a type stands for besides itself.
    SUBTYPES = {"SNV": ("SNP",), "MNV": ("MNP",), "INDEL": ("INSERTION", "DELETION")}

    def types(self, *kinds: str) -> VariantQuery:
        return self.where(F.col("type").isin(*kinds, *(s for k in kinds for s in self.SUBTYPES.get(k, ()))))

    def cohort(self, name: str, present: bool = True) -> VariantQuery:
        c = F.col(f"{name}_opr")
        return self.where(c.isNotNull() if present else c.isNull())

    def genotype(self, wanted: dict[int, Sequence[str]]) -> VariantQuery:
        """Samples are joined by and, a sample's genotypes by or; ``!`` negates."""
        if self.counts is None:
            return self.where(filters.genotype_query(wanted, filters.listed_entry))
        self.table = filters.with_genotypes(self.table, self.counts, wanted, ["chrom", "pos", "ref", "alt"])
        return self

    def named(self, name: str) -> VariantQuery:
        """A registered filter."""
        return self.where(filters.REGISTRY[name])

    def files(self, *ids: int) -> VariantQuery:
        raise NotImplementedError("variants are merged over files")

    def select(self, *columns: str) -> VariantQuery:
        self._columns = columns
        return self

    def order_by(self, *columns: str) -> VariantQuery:
        self._order = columns
        return self

    def limit(self, n: int, skip: int = 0) -> VariantQuery:
        self._limit, self._skip = n, skip
        return self

    def frame(self) -> DataFrame:
        df = self.table.where(filters.all_of(*self._where)) if self._where else self.table
        if self._columns:
            df = df.select(*self._columns)
        if self._order:
            df = df.orderBy(*self._order)
        if self._skip:
            df = df.offset(self._skip)
        return df.limit(self._limit) if self._limit is not None else df

    def count(self) -> int:
        return self.frame().count()

    def rows(self) -> Iterator[Row]:
        """Results one partition at a time."""
        return self.frame().toLocalIterator()


def slot_columns(counts: DataFrame, slots: Sequence[tuple[str, str, int]], samples: Sequence[int] = ()) -> DataFrame:
    """The long count table with a sample list per asked slot: (column, slot, allele); of ``samples`` only, if given."""
    asked = F.col("sample_id").isin(*samples) if samples else F.lit(True)
    aggs = [F.array_sort(F.collect_set(F.when((F.col("slot") == s) & (F.col("allele") == a) & asked, F.col("sample_id")))).alias(name) for name, s, a in slots]
    return counts.groupBy("chrom", "pos", "ref", "alt").agg(*aggs)


#: The list columns of the analysis table.
SLOTS = filters.ENTRIES
