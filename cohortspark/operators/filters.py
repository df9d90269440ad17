"""Variant predicates as columns, the ordered filter chain, and the genotype query."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions import genotype as G

#: Sequence-ontology terms by impact.
HIGH = ("transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained", "frameshift_variant", "stop_lost", "start_lost", "transcript_amplification")
MODERATE = ("inframe_insertion", "inframe_deletion", "missense_variant", "protein_altering_variant", "regulatory_region_ablation")
X = ("X", "chrX")
Y = ("Y", "chrY")


def is_high(term: Column) -> Column:
    return term.isin(*HIGH)


def is_moderate(term: Column) -> Column:
    return term.isin(*MODERATE)


def frequency_below(maf: Column, chrom: Column, cutoff: float, x_cutoff: float) -> Column:
    """Control frequency under its chromosome's cut-off; missing or NaN fails."""
    limit = F.when(chrom.isin(*X), F.lit(x_cutoff)).otherwise(F.lit(cutoff))
    return F.coalesce(~F.isnan(maf) & (maf < limit), F.lit(False))


def stored_frequency_below(maf: Column, cutoff: float) -> Column:
    """The scan's prefilter: a missing frequency passes. As 32 bits, as it is stored, so that no cast hides the column."""
    if not 0 <= cutoff <= 1:
        raise ValueError(f"frequency cut-off outside [0, 1]: {cutoff}")
    return maf.isNull() | (maf < F.lit(cutoff).cast("float"))


def pass_rate_filter(rates: Column, chrom: Column, cutoff: float, by_chrom: dict[tuple[str, ...], float] | None = None) -> Column:
    """No cohort's overall pass rate under the cut-off of the chromosome; a null rate passes. ``rates``: array."""
    limit = F.lit(cutoff)
    for names, value in (by_chrom or {}).items():
        limit = F.when(chrom.isin(*names), F.lit(value)).otherwise(limit)
    return ~F.exists(rates, lambda r: F.coalesce(r < limit, F.lit(False)))


def population_below(frequencies: Column, study: str, population: str, cutoff: float) -> Column:
    """First frequency of a study and population under the cut-off; absent counts as 0. Entries: study, population, af."""
    found = F.filter(frequencies, lambda x: (x["study"] == study) & (x["population"] == population))
    return F.coalesce(F.get(found, F.lit(0))["af"], F.lit(0.0)) < cutoff


def benign(scores: Column) -> Column:
    """Both predictors call the substitution harmless. ``scores``: array of (source, description)."""
    says = lambda source, word: F.exists(scores, lambda s: (s["source"] == source) & (s["description"] == word))
    return says("sift", "tolerated") & says("polyphen", "benign")


def any_benign(consequences: Column) -> Column:
    return F.exists(consequences, lambda c: benign(c["scores"]))


def score_at_least(scores: Column, cutoff: float = 15.0, source: str = "cadd_scaled") -> Column:
    return F.exists(scores, lambda s: (s["source"] == source) & (s["score"] >= cutoff))


def nonsense(term: Column, biotype: Column) -> Column:
    """A protein-coding consequence of high impact."""
    return (biotype == "protein_coding") & is_high(term)


def combined(term: Column, biotype: Column, cadd: Column, is_benign: Column, cutoff: float = 15.0) -> Column:
    """Nonsense, or a protein-coding moderate consequence with a high score that isn't benign."""
    return nonsense(term, biotype) | ((cadd >= cutoff) & (biotype == "protein_coding") & is_moderate(term) & ~is_benign)


def frequency_above(mafs: Column, cutoff: float) -> Column:
    """Any cohort's frequency over the cut-off (keeps common variants); null and NaN don't count."""
    return F.exists(mafs, lambda m: F.coalesce(~F.isnan(m) & (m > cutoff), F.lit(False)))


def type_filter(kind: Column, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> Column:
    """Types to keep; ``include`` wins over ``exclude``."""
    return kind.isin(*include) if include else ~kind.isin(*exclude) if exclude else F.lit(True)


def allow_list(variants: DataFrame, listed: DataFrame) -> DataFrame:
    """Variants whose position and alleles, one shared leading base dropped, are listed (chrom, pos, ref, alt)."""
    key = lambda t: G.normalise(F.col("ref"), F.col("alt"), F.col("pos"))
    names = ["_chrom", "_start", "_ref", "_alt"]
    wanted = listed.withColumn("_k", key(listed)).select(F.col("chrom").alias("_chrom"), F.col("_k.start").alias("_start"), F.col("_k.ref").alias("_ref"), F.col("_k.alt").alias("_alt")).distinct()
    have = variants.withColumn("_k", key(variants)).withColumns({"_chrom": F.col("chrom"), "_start": F.col("_k.start"), "_ref": F.col("_k.ref"), "_alt": F.col("_k.alt")})
    return have.join(wanted, names, "left_semi").select(*variants.columns)


def all_of(*active: Column | None) -> Column:
    """Conjunction of the filters that are set."""
    return reduce(lambda a, b: a & b, [x for x in active if x is not None], F.lit(True))


def first_failed(chain: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first filter in the chain that a row fails; null if it passes all."""
    return F.coalesce(*(F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in chain))


def attrition(rows: DataFrame, chain: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows lost at each filter, and those that pass."""
    return rows.groupBy(F.coalesce(first_failed(chain), F.lit("passed")).alias("first_failed")).agg(F.count("*").alias("n"))


def survivors(rows: DataFrame, chain: Sequence[tuple[str, Column]]) -> DataFrame:
    return rows.where(first_failed(chain).isNull())


def transcripts(rows: DataFrame, consequence: Column) -> DataFrame:
    """Distinct (gene, transcript) of the consequences that pass."""
    return rows.where(consequence).select("gene", "transcript").distinct()


#: Names of the population filters in chain order, and the study each asks for (population ALL).
POPULATIONS = {"ExAC-ALL": "EXAC", "UK10K_TWINSUK": "UK10K_TWINSUK", "UK10K_ALSPAC": "UK10K_ALSPAC", "1kG_phase3": "1kG_phase3", "GNOMAD_GENOMES": "GNOMAD_GENOMES"}


def analysis_chain(kind: str, *, oprs: Column, maf: Column, chrom: Column, biotypes: Column, populations: Column, terms: Column, opr: float = 0.95, maf_auto: float = 0.0001, maf_x: float = 0.000125, pop_af: float = 0.0001) -> list[tuple[str, Column]]:
    """The ordered chain of a ``nonsense`` or ``combined`` analysis."""
    chain = [("OPR", pass_rate_filter(oprs, chrom, opr)), ("CTL-FREQ", frequency_below(maf, chrom, maf_auto, maf_x)), ("protein_coding", F.array_contains(biotypes, "protein_coding"))]
    chain += [(name, population_below(populations, study, "ALL", pop_af)) for name, study in POPULATIONS.items()]
    if kind == "nonsense":
        return [*chain, ("high", F.exists(terms, is_high))]
    if kind == "combined":
        return [*chain, ("highOrModerate", F.exists(terms, lambda t: is_high(t) | is_moderate(t)))]
    raise ValueError(f"unknown analysis: {kind}")


#: The entries that genotype tests look at, as (name, slot, allele); base second alternates are not looked at.
ENTRIES = (("V1", "V", 1), ("V2", "V", 2), ("R1", "R", 1), ("R-1", "R", -1), ("V*_1", "*", 1), ("V*_2", "*", 2), ("V+_1", "+", 1), ("V+_2", "+", 2))


def sample_entries(counts: DataFrame, samples: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """Per variant that one of ``samples`` has an entry at: which entries (``ENTRIES``) each of them has.

    Of the long count table only the asked samples' rows are read and moved.
    """
    rows = counts.where(F.col("sample_id").isin(*samples))
    has = lambda sid, slot, allele: F.max((F.col("sample_id") == sid) & (F.col("slot") == slot) & (F.col("allele") == allele))
    return rows.groupBy(*keys).agg(*(has(sid, slot, allele).alias(f"_has_{sid}_{name}") for sid in samples for name, slot, allele in ENTRIES))


def entry_of(slot: str, sid: int) -> Column:
    """Whether a sample has an entry, by the columns of ``sample_entries``."""
    return F.coalesce(F.col(f"`_has_{sid}_{slot}`"), F.lit(False))


def listed_entry(slot: str, sid: int) -> Column:
    """Whether a sample has an entry, by the slot's list of samples."""
    return F.coalesce(F.array_contains(F.col(f"`{slot}`"), sid), F.lit(False))


def genotype_query(wanted: dict[int, Sequence[str]], has=entry_of) -> Column:
    """Predicate on variant rows: each sample has one of its genotypes (``!`` negates); ``has`` tells its entries."""
    second = ("V*_1", "V*_2", "V+_1", "V+_2")

    def one(sid: int, gt: str) -> Column:
        if gt.startswith("!"):
            return ~one(sid, gt[1:])
        if gt in ("0/1", "1/0"):
            return has("V1", sid) & has("R1", sid)
        if gt == "1/1":
            return has("V2", sid)
        if gt in (".", "./."):
            return has("R-1", sid)
        if gt == "0/0":
            return ~reduce(lambda a, b: a | b, [has(s, sid) for s in ("V1", "R1", "V2", "R-1", *second)])
        return reduce(lambda a, b: a | b, [has(s, sid) for s in second])

    return all_of(*(reduce(lambda a, b: a | b, [one(sid, g) for g in gts]) for sid, gts in wanted.items()))


def with_genotypes(variants: DataFrame, counts: DataFrame, wanted: dict[int, Sequence[str]], keys: Sequence[str]) -> DataFrame:
    """``variants`` at which each sample has one of its genotypes, by the long count table."""
    entries = sample_entries(counts, list(wanted), keys)
    return variants.join(entries, list(keys), "left").where(genotype_query(wanted)).select(*(F.col(f"`{c}`") for c in variants.columns))


#: The registry of named filters that users add to.
REGISTRY: dict[str, Column] = {}


def register_filter(name: str, test: Column) -> None:
    REGISTRY[name] = test
