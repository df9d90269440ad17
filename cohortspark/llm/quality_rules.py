"""Quality rules whose cut-offs come from mergeable quantile sketches per language and source.

Main path: DataFrame functions only. Each metric is a ratio on a logarithmic scale: words'
characters per symbol, lines per repeated line and words per repeated word (each count and
one more, so that a document without any says how few there can be), and characters per
word. A sketch is a histogram of the ratio's bins, ``2 ** STEPS`` to an octave: bins are of
bounded number for any value, their error is relative, and sketches merge by adding
counts. The quartiles of a group set its cut-offs: a document is rejected where a metric
lies beyond the outer fence, the quartile minus (for word length, or plus) ``REACH``
interquartile ranges. No cut-off is fixed; a group so uniform that its quartiles hardly
differ gets a least range (``METRICS``), and what a document has none of can't reject it.
Groups of fewer than ``LEAST_ROWS`` documents use the merged sketch of their language, or
of all documents.

Null text counts as empty (no words: rejected by the base rule). Null languages and
sources form groups of their own. Very long texts are counted whole. Repeated rows each
count and tied values share a bin, so alike documents of a group get one verdict. An empty
table gives an empty table. Other columns are left alone; names beginning with ``_q_`` are
reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import SPACE, WORD, discard, materialise, small

#: Reach of the fences in interquartile ranges, least group, and the base rule.
REACH = 2
LEAST_ROWS = 50
MIN_WORDS = 50
#: Bits of a value that its bin tells: 64 bins to an octave, each about a hundredth wide.
STEPS = 6
#: Per metric the count that has to be positive for a rejection, and the least range in bins.
METRICS = {"symbols": ("n_symbols", 96), "dup_lines": ("n_dup_lines", 96), "repeats": ("n_repeat_words", 96), "word_len": ("n_words", 16)}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def features(text: Column) -> dict[str, Column]:
    """The base counts, and under ``_q_lines`` the lines with a word."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    return {
        "_q_words": F.regexp_extract_all(t, F.lit(WORD), F.lit(0)),
        "word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]", ""))).cast("long"),
        "_q_line_list": lines,
    }


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a three-word window found twice or more.

    Windows are sorted by hash so that equal ones are neighbours; the union of the
    repeated windows is then measured along their positions.
    """

    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))

    def twice(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at"))
    step = lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["at"])).alias("n"), x.alias("at"))
    union = lambda s: F.aggregate(twice(s), start, step, lambda a: a["n"])
    found = let(words, lambda w: F.when(F.size(w) < 3, F.lit(0)).otherwise(let(F.sort_array(windows(w)), union)))
    return found.cast("long")


def with_features(docs: DataFrame, *others: str) -> DataFrame:
    """``others`` of ``docs`` with the base counts, ``base_failed`` and the metrics."""
    keep = [F.col(c) for c in others]
    # a column that isn't deterministic keeps the optimiser from moving the counts into a filter, where each use would count again
    one = docs.select(*keep, F.monotonically_increasing_id().alias("_q_once"), *(c.alias(n) for n, c in features(F.col("text")).items()))
    two = one.select(
        *keep,
        "_q_once",
        "word_chars",
        "n_symbols",
        F.size("_q_words").cast("long").alias("n_words"),
        F.size("_q_line_list").cast("long").alias("_q_lines"),
        (F.size("_q_line_list") - F.size(F.array_distinct("_q_line_list"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_q_words")).alias("n_repeat_words"),
    )
    ratio = lambda a, b: F.expr(f"({2**STEPS} * ({a})) div ({b})")
    return two.select(
        *keep,
        "_q_once",
        *BASE,
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        ratio("word_chars + 1", "n_symbols + 1").alias("_q_symbols"),
        ratio("_q_lines + 1", "n_dup_lines + 1").alias("_q_dup_lines"),
        ratio("n_words + 1", "n_repeat_words + 1").alias("_q_repeats"),
        ratio("word_chars", "greatest(1, n_words)").alias("_q_word_len"),
    ).select(*keep, "_q_once", *BASE, "base_failed", *(bin_of(f"_q_{m}").alias(f"_q_{m}") for m in METRICS))


def bin_of(v: str) -> Column:
    """The bin of a whole number: itself below ``2 ** STEPS``, then ``2 ** STEPS`` to an octave."""
    n = f"length(bin({v}))"
    return F.expr(f"CASE WHEN {v} < {2**STEPS} THEN {v} ELSE {2**STEPS} * ({n} - {STEPS + 1}) + shiftright({v}, {n} - {STEPS + 1}) END").cast("int")


def _keys() -> list[Column]:
    """Group keys without nulls: a null and a text can't meet."""
    return [F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(c))).alias(f"_q_{c}") for c in ("lang", "source")]


def sketches(featured: DataFrame) -> DataFrame:
    """One row per language, source, metric and bin that occurs, with its count."""
    pairs = F.array(*(F.struct(F.lit(m).alias("m"), F.col(f"_q_{m}").alias("v")) for m in METRICS))
    return featured.select(*_keys(), F.explode(pairs).alias("p")).groupBy("_q_lang", "_q_source", F.col("p.m").alias("_q_m"), F.col("p.v").alias("_q_v")).agg(F.count("*").alias("_q_n"))


def quartiles(sketch: DataFrame) -> DataFrame:
    """Size and quartiles (smallest bin that reaches the rank) of each metric, per group, per language and of all.

    A level that a key isn't part of has "*" there, which no key can be.
    """
    level = lambda lang, source: F.struct((F.col("_q_lang") if lang else F.lit("*")).alias("_q_l"), (F.col("_q_source") if source else F.lit("*")).alias("_q_s"))
    levels = F.explode(F.array(level(True, True), level(True, False), level(False, False))).alias("k")
    merged = sketch.select(levels, "_q_m", "_q_v", "_q_n").groupBy("k._q_l", "k._q_s", "_q_m", "_q_v").agg(F.sum("_q_n").alias("_q_n"))
    w = W.partitionBy("_q_l", "_q_s", "_q_m")
    ran = merged.select("_q_l", "_q_s", "_q_m", "_q_v", F.sum("_q_n").over(w.orderBy("_q_v").rowsBetween(W.unboundedPreceding, 0)).alias("run"), F.sum("_q_n").over(w).alias("all"))
    at = lambda k: F.min(F.when(4 * F.col("run") >= k * F.col("all"), F.col("_q_v")))
    return ran.groupBy("_q_l", "_q_s", "_q_m").agg(F.first("all").alias("n"), at(1).alias("lo"), at(3).alias("hi"))


def fences(levels: DataFrame) -> DataFrame:
    """From written quartiles, per language and source: the lowest bin that passes of each metric, and the highest of word length."""
    own = levels.where("_q_s != '*'").select(F.col("_q_l").alias("_q_lang"), F.col("_q_s").alias("_q_source"), "_q_m", "n", "lo", "hi")
    lang = levels.where("_q_l != '*' AND _q_s = '*'").select(F.col("_q_l").alias("_q_lang"), "_q_m", *(F.col(c).alias(f"{c}_lang") for c in ("n", "lo", "hi")))
    every = levels.where("_q_l = '*'").select("_q_m", *(F.col(c).alias(f"{c}_all") for c in ("lo", "hi")))  # a row per metric
    t = own.join(small(lang), ["_q_lang", "_q_m"]).join(F.broadcast(every), "_q_m")
    pick = lambda x: F.when(F.col("n") >= LEAST_ROWS, F.col(x)).when(F.col("n_lang") >= LEAST_ROWS, F.col(f"{x}_lang")).otherwise(F.col(f"{x}_all"))
    t = t.select("_q_lang", "_q_source", "_q_m", pick("lo").alias("lo"), pick("hi").alias("hi"))
    cuts = []
    for m, (_, least) in METRICS.items():
        reach = REACH * F.greatest(F.col("hi") - F.col("lo"), F.lit(least))
        cuts.append(F.max(F.when(F.col("_q_m") == m, F.col("lo") - reach)).alias(f"_q_min_{m}"))
    return t.groupBy("_q_lang", "_q_source").agg(*cuts, F.max(F.when(F.col("_q_m") == m, F.col("hi") + reach)).alias(f"_q_max_{m}"))


def verdict(featured: DataFrame, fence: DataFrame) -> DataFrame:
    """``featured`` with ``kept``; the fences are joined by group (broadcast only if few)."""
    keyed = featured.select("*", *_keys())
    inside = F.col("_q_word_len") <= F.col("_q_max_word_len")
    for m, (count, _) in METRICS.items():
        inside = inside & ((F.col(count) == 0) | (F.col(f"_q_{m}") >= F.col(f"_q_min_{m}")))
    joined = keyed.join(small(fence), ["_q_lang", "_q_source"])
    return joined.withColumn("kept", ~F.col("base_failed") & inside).select(*(F.col(f"`{c}`") for c in featured.columns), "kept")


def _fences_of(featured: DataFrame) -> DataFrame:
    """The fences of a written table: one row per language and source."""
    levels = materialise(quartiles(sketches(featured)), "quality-quartiles")
    fence = materialise(fences(levels), "quality-fences")
    discard(levels)
    return fence


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, the base counts, ``base_failed`` and ``kept``."""
    thin = materialise(with_features(docs, "doc_id", "lang", "source"), "quality-features")
    return verdict(thin, _fences_of(thin)).select("doc_id", *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; each text is counted once and written beside its counts."""
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_q_row"), "text", "lang", "source")
    rows = materialise(with_features(held, "_q_row", "lang", "source"), "quality-rows")
    return verdict(rows, _fences_of(rows)).where("kept").select("_q_row.*")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (SELECT rid, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g FROM w, unnest(range(1, len(w) - 1)) u(i)),
dup AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + j) AS n FROM dup, unnest([0, 1, 2]) v(j) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n, count(DISTINCT x) AS u FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM w) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
f AS (SELECT w.rid, doc_id, coalesce('=' || lang, '-') AS l, coalesce('=' || source, '-') AS s, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(lines.n, 0) AS n_lines, CAST(coalesce(lines.n - lines.u, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid)),
r AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  unnest([1, 2, 3, 4]) AS m, unnest([64 * (word_chars + 1) // (n_symbols + 1), 64 * (n_lines + 1) // (n_dup_lines + 1), 64 * (n_words + 1) // (n_repeat_words + 1), 64 * word_chars // greatest(1, n_words)]) AS v,
  unnest([n_symbols, n_dup_lines, n_repeat_words, n_words]) AS c FROM f),
b AS (SELECT *, CASE WHEN v < 64 THEN v ELSE 64 * (length(bin(v)) - 7) + (v >> (length(bin(v)) - 7)) END AS b FROM r),
own AS (SELECT l, s, m, count(*) AS n, quantile_disc(b, 0.25) AS lo, quantile_disc(b, 0.75) AS hi FROM b GROUP BY l, s, m),
lang AS (SELECT l, m, count(*) AS n, quantile_disc(b, 0.25) AS lo, quantile_disc(b, 0.75) AS hi FROM b GROUP BY l, m),
every AS (SELECT m, quantile_disc(b, 0.25) AS lo, quantile_disc(b, 0.75) AS hi FROM b GROUP BY m),
pick AS (SELECT own.l, own.s, own.m, CASE WHEN own.n >= 50 THEN own.lo WHEN lang.n >= 50 THEN lang.lo ELSE every.lo END AS lo,
  CASE WHEN own.n >= 50 THEN own.hi WHEN lang.n >= 50 THEN lang.hi ELSE every.hi END AS hi FROM own JOIN lang USING (l, m) JOIN every USING (m)),
fence AS (SELECT l, s, m, lo - 2 * greatest(hi - lo, CASE m WHEN 4 THEN 16 ELSE 96 END) AS low, CASE m WHEN 4 THEN hi + 2 * greatest(hi - lo, 16) ELSE 1000000 END AS high FROM pick)
SELECT any_value(doc_id) AS doc_id, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols, any_value(n_dup_lines) AS n_dup_lines,
  any_value(n_repeat_words) AS n_repeat_words, bool_or(base_failed) AS base_failed, NOT bool_or(base_failed) AND bool_and((c = 0 OR b >= low) AND b <= high) AS kept
FROM b JOIN fence USING (l, s, m) GROUP BY rid
"""
