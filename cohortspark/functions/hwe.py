"""Exact two-sided Hardy-Weinberg test (Wigginton, Cutler and Abecasis, 2005) as a column.

Given the allele counts, the probability of ``h`` heterozygotes is proportional to
``2**h / (n_aa! h! n_bb!)``. Ratios of neighbours lead outwards from the observed count
in both directions; sums are kept as logarithms, so no count is too unlikely. One fold
over the possible ``h`` inside Spark, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _log_sum(hs: Column, log_ratio) -> Column:
    """Log of 1 plus the weights along ``hs``, each the last one times its ratio."""
    start = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("sum"))

    def step(a: Column, h: Column) -> Column:
        w = a["w"] + log_ratio(h)
        top = F.greatest(a["sum"], w)
        return F.struct(w.alias("w"), (top + F.log(F.exp(a["sum"] - top) + F.exp(w - top))).alias("sum"))

    return F.aggregate(hs, start, step, lambda a: a["sum"])


def _p_value(v: Column) -> Column:
    n, rare, ab = v["n"], v["rare"], v["ab"]
    none, two = F.array().cast("array<bigint>"), F.lit(2).cast("bigint")
    both = lambda h: ((rare - h) / 2, n - h - (rare - h) / 2)  # noqa: E731  homozygotes of either kind beside h heterozygotes

    def from_below(h: Column) -> Column:
        a, b = both(h)
        return F.log(4.0 * (a + 1) * (b + 1) / (h * (h - 1.0)))

    def from_above(h: Column) -> Column:
        a, b = both(h)
        return F.log((h + 2.0) * (h + 1.0) / (4.0 * a * b))

    up = _log_sum(F.when(ab + 2 <= rare, F.sequence(ab + 2, rare, two)).otherwise(none), from_below)
    down = _log_sum(F.when(ab >= 2, F.sequence(ab - 2, F.pmod(rare, two), -two)).otherwise(none), from_above)

    def tails(s: Column) -> Column:
        top = F.greatest(s["up"], s["down"])
        total = top + F.log(F.exp(s["up"] - top) + F.exp(s["down"] - top) - F.exp(-top))
        high, low = F.exp(s["up"] - total), F.exp(s["down"] - total)
        return F.when((high > 0.5) & (low > 0.5), 1.0).otherwise(2 * F.least(high, low))

    return F.get(F.transform(F.array(F.struct(up.alias("up"), down.alias("down"))), tails), F.lit(0))


def exact_p(hom1: Column, het: Column, hom2: Column) -> Column:
    """p-value: twice the smaller tail (observed count included), 1 where both exceed a half, -1 without samples."""
    aa, bb, ab = F.least(hom1, hom2).cast("bigint"), F.greatest(hom1, hom2).cast("bigint"), het.cast("bigint")
    given = F.array(F.struct((aa + ab + bb).alias("n"), (2 * aa + ab).alias("rare"), ab.alias("ab")))
    return F.when(aa + ab + bb < 1, F.lit(-1.0)).otherwise(F.get(F.transform(given, _p_value), F.lit(0)))
