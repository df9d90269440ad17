"""Annotation of variants by a table or a callable annotator."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["chrom", "pos", "ref", "alt"]


def missing(variants: DataFrame, annotations: DataFrame, force: bool = False) -> DataFrame:
    """Variants to annotate: all if forced, else those without a usable annotation."""
    if force:
        return variants
    usable = annotations.where(F.col("chrom").isNotNull() & (F.col("chrom") != ""))
    return variants.join(usable.select(*KEYS).distinct(), KEYS, "left_anti")


def annotate(variants: DataFrame, annotations: DataFrame) -> DataFrame:
    """Variants with their annotation, null where there is none."""
    return variants.join(annotations, KEYS, "left")


def annotate_with(variants: DataFrame, annotator: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch: int = 200, parallel: int = 5) -> DataFrame:
    """Variants sent to a callable (a remote service, say) in batches, by a bounded number of tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for s in range(0, len(f), batch):
                yield annotator(f.iloc[s : s + batch])

    return variants.select(*KEYS).repartition(parallel).mapInPandas(run, schema)
