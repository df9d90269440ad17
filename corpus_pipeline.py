"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last
return the columns of documents. ``run`` writes each stage's rows to the shared folder
and reads them again for the next one; what no later stage reads is deleted.

In every stage a null text counts as empty, null ids, languages and sources are rows and
groups of their own, texts of any length are taken whole, repeated rows are rows, further
columns pass through whatever their names (all stages but the last; names that begin
with ``_q_`` or ``_m_`` are reserved), and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortspark.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from cohortspark.llm.common import discard, discard_since, materialise, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, those without 50 words among them; repeated rows get one verdict."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays: the longest original, then the smallest id, a null id last; of rows alike in all one."""
    return exact_dedup.survivors(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the one with the smallest id stays; rows without an id and texts without words stay."""
    return ngram_join.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as its source's target takes it; rows alike in id and text are taken alike."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and place; a text without tokens is one piece of its end id."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram join", near), ("mixing", mix), ("packing", pack)]

#: Tokens and packing have no SQL; tests/llm hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, since = docs, written()
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{k}")
            discard_since(since, docs)
            discard(before)
    return docs
