"""Settings of analyses and exports in one place, with their defaults, and the filters they stand for."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.operators import filters

#: Option names behind the common prefix, by field.
ANALYSIS_KEYS = {
    "analysis.mr.analysis.type": "kind",
    "analysis.association.cases": "cases",
    "analysis.association.controls": "controls",
    "analysis.filter.ctrl.maf.auto": "maf_auto",
    "analysis.filter.ctrl.maf.X": "maf_x",
    "analysis.filter.pop.af": "pop_af",
    "analysis.filter.opr": "opr",
    "analysis.analysis.combined.cadd": "cadd",
    "analysis.prefilter.ctrl.maf": "prefilter",
}
EXPORT_KEYS = {
    "storage.allele.opr.cohorts": "opr_cohorts",
    "storage.allele.opr.cutoff": "opr",
    "storage.allele.opr.x.cohorts": "opr_x_cohorts",
    "storage.allele.opr.x.cutoff": "opr_x",
    "storage.allele.opr.y.cohorts": "opr_y_cohorts",
    "storage.allele.opr.y.cutoff": "opr_y",
    "storage.allele.maf.cohorts": "maf_cohorts",
    "storage.allele.maf.cutoff": "maf",
    "storage.allele.type.include": "include",
    "storage.allele.type.exclude": "exclude",
}


def _from(cls, keys: Mapping[str, str], options: Mapping[str, object]):
    """A configuration from options by name; lists may be comma-separated text, unknown names raise."""
    kinds = {f.name: f.type for f in fields(cls)}
    found = {}
    for key, value in options.items():
        if key not in keys:
            raise ValueError(f"unknown option: {key}")
        kind = kinds[keys[key]]
        if "tuple" in kind:
            value = tuple(x.strip() for x in value.split(",") if x.strip()) if isinstance(value, str) else tuple(value)
        elif "float" in kind:
            value = float(value)
        found[keys[key]] = value
    return cls(**found)


@dataclass(frozen=True)
class AnalysisConfig:
    """A case/control analysis: ``nonsense`` or ``combined``."""

    kind: str
    cases: str
    controls: str
    maf_auto: float = 0.0001
    maf_x: float = 0.000125
    pop_af: float = 0.0001
    opr: float = 0.95
    cadd: float = 15.0
    prefilter: float | None = None

    @classmethod
    def of(cls, options: Mapping[str, object]) -> AnalysisConfig:
        return _from(cls, ANALYSIS_KEYS, options)

    @property
    def scan_cutoff(self) -> float:
        """The frequency below which the scan reads: by default the larger of the two cut-offs."""
        return max(self.maf_auto, self.maf_x) if self.prefilter is None else self.prefilter

    def chain(self, **columns: Column) -> list[tuple[str, Column]]:
        """The ordered filter chain over the given columns."""
        return filters.analysis_chain(self.kind, opr=self.opr, maf_auto=self.maf_auto, maf_x=self.maf_x, pop_af=self.pop_af, **columns)


@dataclass(frozen=True)
class ExportConfig:
    """Filters of an export; each is off without its cohorts, types or list."""

    opr_cohorts: tuple[str, ...] = ()
    opr: float = -1.0
    opr_x_cohorts: tuple[str, ...] = ()
    opr_x: float = -1.0
    opr_y_cohorts: tuple[str, ...] = ()
    opr_y: float = -1.0
    maf_cohorts: tuple[str, ...] = ()
    maf: float = -1.0
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()

    @classmethod
    def of(cls, options: Mapping[str, object]) -> ExportConfig:
        return _from(cls, EXPORT_KEYS, options)

    def test(self, chrom: Column, kind: Column, opr, maf) -> Column:
        """Whether a variant passes all filters that are set; ``opr`` and ``maf`` give a cohort's value by name.

        X and Y have cohorts and cut-offs of their own where these are set, else the
        common ones; a missing rate passes.
        """
        passes = lambda cohorts, cutoff: filters.pass_rate_filter(F.array(*map(opr, cohorts)), chrom, cutoff) if cohorts else F.lit(True)
        rates = F.when(chrom.isin(*filters.X), passes(self.opr_x_cohorts, self.opr_x)) if self.opr_x_cohorts else None
        if self.opr_y_cohorts:
            own = passes(self.opr_y_cohorts, self.opr_y)
            rates = F.when(chrom.isin(*filters.Y), own) if rates is None else rates.when(chrom.isin(*filters.Y), own)
        common = passes(self.opr_cohorts, self.opr)
        rates = common if rates is None else rates.otherwise(common)
        frequent = filters.frequency_above(F.array(*map(maf, self.maf_cohorts)), self.maf) if self.maf_cohorts else None
        return filters.all_of(rates, frequent, filters.type_filter(kind, self.include, self.exclude))

    def apply(self, rows: DataFrame, listed: DataFrame | None = None) -> DataFrame:
        """Export rows (chrom, pos, ref, alt, type, stats by cohort) that pass; ``listed``: an allow-list, if any."""
        of = lambda name: lambda cohort: F.try_element_at("stats", F.lit(cohort))[name].cast("double")
        kept = rows.where(self.test(F.col("chrom"), F.col("type"), of("overallPassrate"), of("maf")))
        return kept if listed is None else filters.allow_list(kept, listed)
