"""Mixing sources to target weights by hash order and distributed prefix sums.

Main path: DataFrame functions only. Each source's target is its weight's share of all
words, stopped at ``MOST_EPOCHS`` times its size, the excess shared again by weight.
Within a source documents stand in the order of a hash key. Ranges of the key (leading
hexadecimal digits, as many as the row count needs) are summed first; the part that
holds the cut is then narrowed by two digits a step, first over the ranges' sums and then
over the keys of one range, each step a prefix sum over at most 256 parts of a source;
whole epochs come before. So every row decides by comparing its key with its source's
cut, no text is moved, and no task holds a source.

Null text has no words; a null source is a source, last in order; rows alike in id and
text share a key and are taken alike. A source without words takes nothing. An empty
table gives an empty table. Names beginning with ``_m_`` are reserved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD, discard, discard_since, materialise, small, written

#: Weights dealt to the sources in order, again and again, and the most epochs.
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Rows that a range of keys holds on average, at most.
RANGE_ROWS = 50_000
#: Hexadecimal digits of a key, and by how many a step narrows the part that holds the cut.
KEY_DIGITS = 32
DIGITS = 2


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))


def _source() -> Column:
    return F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("source")))


def targets(sizes: DataFrame) -> DataFrame:
    """From one row per source (source, _m_source, source_size): weight and target.

    Sources in order of the level at which they stop: each stops if its level lies
    within what the sources not yet stopped would get.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int")).cast("long")
    t = sizes.withColumn("_m_w", weight).withColumn("_m_cap", MOST_EPOCHS * F.col("source_size"))
    every, level = W.partitionBy(), W.orderBy(F.col("_m_cap") / F.col("_m_w"), "_m_source")
    before = level.rowsBetween(W.unboundedPreceding, -1)
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    t = t.withColumn("_m_left", sum_of("source_size", every) - sum_of("_m_cap", before)).withColumn("_m_wleft", sum_of("_m_w", every) - sum_of("_m_w", before))
    t = t.withColumn("_m_stops", F.col("_m_cap") * F.col("_m_wleft") <= F.col("_m_w") * F.col("_m_left"))
    t = t.withColumn("_m_left", sum_of("source_size", every) - sum_of(F.when(F.col("_m_stops"), F.col("_m_cap")), every))
    t = t.withColumn("_m_wleft", sum_of("_m_w", every) - sum_of(F.when(F.col("_m_stops"), F.col("_m_w")), every))
    target = F.when(F.col("_m_stops"), F.col("_m_cap").cast("double")).otherwise((F.col("_m_w") * F.col("_m_left")).cast("double") / F.col("_m_wleft"))
    t = t.withColumn("target", target)
    epochs = F.expr("CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) div source_size ELSE 0L END")
    t = t.withColumn("_m_epochs", epochs)
    return t.select("source", "_m_source", "source_size", "target", "_m_epochs", (F.floor("target") - F.col("_m_epochs") * F.col("source_size")).cast("long").alias("_m_rest"))


def _narrowed(rows: DataFrame, hit: DataFrame, above: int, below: int) -> DataFrame:
    """Of each source the part of ``below`` digits of the key in which its rest ends, within ``hit``'s part of ``above`` digits.

    ``_m_rest`` words are still to be taken in that part, which has ``_m_tied``.
    """
    inside = rows.withColumn("_m_cut", F.substring("_m_key", 1, above)).join(small(hit.select("_m_source", "_m_cut", "_m_rest")), ["_m_source", "_m_cut"])
    parts = inside.groupBy("_m_source", F.substring("_m_key", 1, below).alias("_m_part")).agg(F.sum("_m_n").alias("_m_tied"), F.first("_m_rest").alias("_m_rest"))
    run = F.sum("_m_tied").over(W.partitionBy("_m_source").orderBy("_m_part").rowsBetween(W.unboundedPreceding, 0))
    before = parts.withColumn("_m_run", run - F.col("_m_tied")).where((F.col("_m_rest") >= F.col("_m_run")) & (F.col("_m_rest") < F.col("_m_run") + F.col("_m_tied")))
    return materialise(before.select("_m_source", F.col("_m_part").alias("_m_cut"), (F.col("_m_rest") - F.col("_m_run")).alias("_m_rest"), "_m_tied"), "mix-cut")


def cuts(thin: DataFrame) -> DataFrame:
    """One row per source: target, whole epochs, and the key where the last one is cut.

    ``_m_rest`` words are still to be taken at the cut key, whose rows have ``_m_tied`` words.
    """
    since = written()
    digits = max(1, math.ceil(math.log(max(1, thin.count()) / RANGE_ROWS, 16)))
    ranges = thin.groupBy("_m_source", F.substring("_m_key", 1, digits).alias("_m_key")).agg(F.sum("size").alias("_m_n"), F.first("source", True).alias("source"))
    sums = materialise(ranges, "mix-ranges")
    goal = materialise(targets(sums.groupBy("_m_source").agg(F.first("source", True).alias("source"), F.sum("_m_n").alias("source_size"))), "mix-targets")
    hit = goal.select("_m_source", F.lit("").alias("_m_cut"), "_m_rest")
    for above in range(0, digits, DIGITS):
        hit = _narrowed(sums, hit, above, min(above + DIGITS, digits))
    ranged = thin.select("_m_source", "_m_key", "size", F.substring("_m_key", 1, digits).alias("_m_cut"))
    last = ranged.join(small(hit.select("_m_source", "_m_cut")), ["_m_source", "_m_cut"]).groupBy("_m_source", "_m_key").agg(F.sum("size").alias("_m_n"))
    keys = materialise(last, "mix-keys")
    for above, below in ((digits, digits + DIGITS), (digits + DIGITS, KEY_DIGITS)):
        hit = _narrowed(keys, hit, above, below)
    found = materialise(goal.drop("_m_rest").join(hit, "_m_source", "left"), "mix-cuts")
    discard_since(since, found)
    return found


def mix(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target and ``taken`` words; sums meet each target's whole words."""
    thin = materialise(docs.select("doc_id", "source", _source().alias("_m_source"), words(F.col("text")).alias("size"), _key(F.col("doc_id"), F.col("text")).alias("_m_key")), "mix-sizes")
    joined = thin.drop("source").join(small(cuts(thin).drop("source")), "_m_source")
    part = F.expr("CASE WHEN _m_key < _m_cut THEN size WHEN _m_key = _m_cut THEN (size * _m_rest) div greatest(_m_tied, 1L) ELSE 0L END")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("_m_epochs") * F.col("size") + part).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Whole rows of ``docs``, each as often as the mix takes it; the cut falls at the nearer end of a document."""
    thin = materialise(docs.select("source", _source().alias("_m_source"), words(F.col("text")).alias("size"), _key(F.col("doc_id"), F.col("text")).alias("_m_key")), "mix-sizes")
    cut = small(cuts(thin).drop("source", "source_size", "target"))
    discard(thin)
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_m_row"), _source().alias("_m_source"), _key(F.col("doc_id"), F.col("text")).alias("_m_key"))
    more = F.expr("CASE WHEN _m_key < _m_cut OR (_m_key = _m_cut AND 2 * _m_rest >= _m_tied) THEN 1L ELSE 0L END")
    copies = row.join(cut, "_m_source").withColumn("_m_copies", (F.col("_m_epochs") + more).cast("int"))
    return copies.where("_m_copies > 0").select("_m_row", F.explode(F.array_repeat(F.lit(0), F.col("_m_copies")))).select("_m_row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce('=' || source, '-') AS s, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
z AS (SELECT s, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY s),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 3 * source_size AS cap FROM z),
a AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS wall, coalesce(sum(cap) OVER o, 0) AS capped, coalesce(sum(w) OVER o, 0) AS wcapped FROM w
  WINDOW o AS (ORDER BY cap / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, cap * (wall - wcapped) <= w * (total - capped) AS stops FROM a),
g AS (SELECT *, CASE WHEN stops THEN CAST(cap AS DOUBLE) ELSE CAST(w * (total - coalesce(sum(cap) FILTER (WHERE stops) OVER (), 0)) AS DOUBLE) / CAST(wall - coalesce(sum(w) FILTER (WHERE stops) OVER (), 0) AS DOUBLE) END AS target FROM b),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM g),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, CAST(floor(e.target) AS BIGINT) - e.epochs * e.source_size AS rest,
  sum(size) OVER (PARTITION BY d.s ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run, sum(size) OVER (PARTITION BY d.s, k) AS tied FROM d JOIN e USING (s))
SELECT doc_id, size, source_size, target, CAST(epochs * size + CASE WHEN rest >= run THEN size WHEN rest <= run - tied THEN 0 ELSE (size * (rest - run + tied)) // greatest(tied, 1) END AS BIGINT) AS taken FROM p
"""
