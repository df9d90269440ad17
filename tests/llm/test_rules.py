"""Quality rules: cut-offs that the groups' own sketches set."""

from __future__ import annotations

import random

import brute
from pyspark.sql import functions as F

from cohortspark.llm import quality_rules


def _text(rnd, n, share=0.0):
    """``n`` words of which about ``share`` end in a symbol."""
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) + ("#" if rnd.random() < share else "") for _ in range(n))


def test_cut_offs_follow_the_source(spark):
    """One text, in a source that is full of symbols and in one that has none; and one with long words."""
    rnd = random.Random(4)
    noisy, long_words = _text(rnd, 200, 0.4), " ".join("x" * 9 + str(k % 10) + f"{k:03d}"[:2] for k in range(120))
    rows = [(i, _text(rnd, rnd.randint(100, 300), 0.4), "en", "code") for i in range(80)]
    rows += [(i, _text(rnd, rnd.randint(100, 300)), "en", "prose") for i in range(100, 180)]
    rows += [(i, " ".join(f"{rnd.randrange(10**11):011d}" for _ in range(150)), "en", "tables") for i in range(200, 280)]
    rows += [(900, noisy, "en", "code"), (901, noisy, "en", "prose"), (902, long_words, "en", "tables"), (903, long_words, "en", "prose")]
    docs = brute.documents(spark, rows)
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    assert kept[900] and not kept[901] and kept[902] and not kept[903]
    assert all(k for d, k in kept.items() if d < 900)
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == {d for d, k in kept.items() if k}
    thin = quality_rules.with_features(docs, "doc_id", "lang", "source")
    cuts = {r._q_source: r for r in quality_rules.fences(quality_rules.quartiles(quality_rules.sketches(thin))).collect()}
    assert cuts["=code"]._q_min_symbols < cuts["=prose"]._q_min_symbols and cuts["=prose"]._q_max_word_len < cuts["=tables"]._q_max_word_len


def test_most_cut_offs_differ(spark):
    """On the given tables no value is the cut-off of most groups."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    thin = quality_rules.with_features(docs, "lang", "source")
    rows = quality_rules.fences(quality_rules.quartiles(quality_rules.sketches(thin))).collect()
    for c in ("_q_min_symbols", "_q_min_repeats", "_q_max_word_len"):
        found = [r[c] for r in rows]
        assert max(map(found.count, found)) <= len(found) / 4


def test_uniform_groups_and_what_a_text_has_none_of(spark):
    """Texts of one length and no symbols leave shorter clean ones and a single symbol alone."""
    words = lambda i, n: " ".join(f"w{i:03d}{k:03d}" for k in range(n))
    rows = [(i, words(i, 400)) for i in range(60)] + [(100, words(100, 55)), (101, words(101, 120) + " &"), (102, "#$%& " * 60 + words(102, 20))]
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(brute.documents(spark, rows)).collect()}
    assert [d for d, k in kept.items() if not k] == [102]


def test_sketches_merge(spark):
    """Sketches of parts, added up, are the sketch of the whole; small groups take their language's cut-offs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    thin = quality_rules.with_features(docs, "doc_id", "lang", "source")
    whole = quality_rules.quartiles(quality_rules.sketches(thin))
    parts = quality_rules.sketches(thin.where("doc_id % 3 = 0")).unionByName(quality_rules.sketches(thin.where("doc_id % 3 <> 0")))
    assert sorted(map(tuple, quality_rules.quartiles(parts).collect())) == sorted(map(tuple, whole.collect()))
    cuts = quality_rules.fences(whole).collect()
    assert max(r.n for r in whole.where("_q_s <> '*'").collect()) < quality_rules.LEAST_ROWS
    assert all(len({tuple(r)[2:] for r in cuts if r._q_lang == lang}) == 1 for lang in {r._q_lang for r in cuts})


def test_bins_are_monotone_and_fine(spark):
    values = sorted({*range(300), *(int(1.03**k) for k in range(900)), 2**62})
    got = [r.b for r in spark.createDataFrame([(v,) for v in values], "v long").select("v", quality_rules.bin_of("v").alias("b")).orderBy("v").collect()]
    assert got == sorted(got) and got[:128] == list(range(128)) and len(set(got[values.index(299) :])) > 700 and got[-1] < 4096


def test_edge_values(spark):
    """Nulls, blanks, a very long text, ties, repeated rows and clashing names."""
    long = " ".join(f"w{i}" for i in range(120_000))
    same = " ".join(f"x{i}" for i in range(60))
    rows = [(1, None, None, None), (2, "", "en", None), (3, " \n\t", None, "s"), (4, long, "en", "s"), (None, same, "en", "s"), (5, same, "en", "s"), (5, same, "en", "s"), (6, "a #b\na #b\n\nc " + same, "en", "s"), (7, "one two three " * 40, "en", "s")]
    docs = brute.documents(spark, rows).withColumns({c: F.lit("x") for c in ("n_words", "kept", "base_failed", "m", "lo", "n", "a.b")})
    got = quality_rules.quality_rules(docs).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    by = {r.doc_id: tuple(r)[1:] for r in got}
    assert by[1] == by[2] == by[3] == (0, 0, 0, 0, 0, True, False)
    assert by[4] == (120_000, len(long.replace(" ", "")), 0, 0, 0, False, True)
    assert by[None] == by[5] == (60, len(same.replace(" ", "")), 0, 0, 0, False, True)
    assert by[6][:5] == (65, len(same.replace(" ", "")) + 7, 2, 1, 0) and by[7] == (120, 440, 0, 0, 120, True, False)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(["4", "None", "5", "5"] + ["6"] * by[6][-1])
