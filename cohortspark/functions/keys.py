"""Sortable keys of positions: chromosome and position as one string and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits of a position; a key sorts as its position does.
DIGITS = 10
#: Rows under this lead hold a table's own metadata.
METADATA = "_METADATA"


def position_key(chrom: Column, pos: Column) -> Column:
    return F.concat(chrom, F.lit("_"), F.lpad(pos.cast("string"), DIGITS, "0"))


def parse_position_key(key: Column) -> Column:
    """A key's (chrom, pos); the chromosome may hold an underscore itself."""
    return F.struct(F.left(key, F.length(key) - (DIGITS + 1)).alias("chrom"), F.right(key, F.lit(DIGITS)).cast("int").alias("pos"))


def is_metadata(key: Column) -> Column:
    """Whether a key begins with the metadata lead (not the other way round)."""
    return F.coalesce(F.startswith(key, F.lit(METADATA)), F.lit(False))
