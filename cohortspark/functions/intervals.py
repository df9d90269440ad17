"""Interval algebra on two integer columns; an insertion has its end before its start."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lowest(start: Column, end: Column) -> Column:
    return F.least(start, end)


def highest(start: Column, end: Column) -> Column:
    return F.greatest(start, end)


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column, insertion_aware: bool = False) -> Column:
    """Whether two intervals meet; insertion-aware ones begin at their start, not at their end."""
    same = (s1 == s2) & (e1 == e2)
    if insertion_aware:
        return same | ((s1 <= F.greatest(s2, e2)) & (s2 <= F.greatest(s1, e1)))
    return same | ((F.least(s1, e1) <= F.greatest(s2, e2)) & (F.least(s2, e2) <= F.greatest(s1, e1)))


def covered_by(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return (F.least(s2, e2) <= F.least(s1, e1)) & (F.greatest(s2, e2) >= F.greatest(s1, e1))


def length(start: Column, end: Column) -> Column:
    """Positions from start to end; negative for an insertion."""
    return F.when(end >= start, end - start + 1).otherwise(end - start)


def positions(start: Column, end: Column) -> Column:
    return F.abs(end - start) + 1


def clip(start: Column, end: Column, low: int | Column, high: int | Column) -> tuple[Column, Column]:
    """The interval cut to a window."""
    return F.greatest(start, F.lit(low)), F.least(end, F.lit(high))


def bins(start: Column, end: Column, width: int) -> Column:
    """Every bin that an interval touches."""
    low, high = F.least(start, end), F.greatest(start, end)
    return F.sequence(F.floor(low / width).cast("int"), F.floor(high / width).cast("int"))


def bin_of(pos: Column, width: int) -> Column:
    return F.floor(pos / width).cast("int")
