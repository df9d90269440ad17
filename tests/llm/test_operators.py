"""The ten operators on edge cases and against brute force."""

from __future__ import annotations

import math
import os
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import brute
import numpy as np
import pytest
from compare import assert_same

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortspark.llm import exact_dedup, language_id, main_text, mixing, ngram_join, packing, pii, quality_model, quality_rules, queries, secrets, textbytes

TINY = os.environ.get("TINY", "/root/testdata/sf0.001")
LONG = "lorem ipsum dolor " * 30_000
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, LONG), (6, "same words in this text here"), (7, "same words in this text here"), (None, "no id at all in this row"), (8, "Ünïcödé wörds 中文 text 𝔸 here"), (8, "Ünïcödé wörds 中文 text 𝔸 here")]


def edges(spark):
    """Nulls, blanks, a very long text, ties, repeated rows, and columns whose names clash with inner ones."""
    d = brute.documents(spark, [(*r, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s") for i, r in enumerate(EDGES)])
    return d.withColumns({c: F.lit("x") for c in ("size", "target", "row", "norm", "node", "label", "n", "length", "kept", "n_words", "_extra")})


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    assert_same(queries.queries()[name](spark, TINY), duck, queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_covers_its_table(spark, name):
    df = queries.queries()[name](spark, TINY)
    key, table = ("page_id", "pages") if "main_text" in name else ("doc_id", "documents")
    assert {r[0] for r in df.select(key).collect()} == {r[0] for r in spark.read.parquet(f"{TINY}/{table}.parquet").select(key).collect()}


def test_empty_tables(spark):
    none = edges(spark).where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (quality_model.classify(none, labels), pii.find_personal_data(none), exact_dedup.exact_dedup(none), main_text.extract(pages), mixing.mix(none), secrets.find_secrets(none), ngram_join.similar_groups(none), quality_rules.quality_rules(none), language_id.identify(none), packing.pack(none), exact_dedup.survivors(none), ngram_join.representatives(none), quality_rules.keep_good(none), mixing.mixed_documents(none)):
        assert df.count() == 0


# --- exact dedup


def test_dedup_edges(spark):
    got = {(r.doc_id, r.kept): r for r in exact_dedup.exact_dedup(edges(spark)).collect()}
    assert {d for d, k in got if k} == {3, 4, 5, 6, 8, None}
    assert got[1, False].keep_id == got[2, False].keep_id == 3 and got[1, False].group_size == 3
    assert got[7, False].keep_id == 6
    assert got[8, True].group_size == got[8, False].group_size == 2
    kept = exact_dedup.survivors(edges(spark))
    assert kept.columns == edges(spark).columns and kept.count() == 6


def test_dedup_group_over_many_partitions(spark):
    """A third of all rows is one group; its runs meet over partition ends."""
    docs = brute.documents(spark, [(i, "a hot text" if i % 3 else f"text {i % 40}") for i in range(600)]).repartition(7)
    got = exact_dedup.exact_dedup(docs)
    want = {}
    for i in range(600):
        want.setdefault("a hot text" if i % 3 else f"text {i % 40}", []).append(i)
    sizes = {i: (ids[0], len(ids), i == ids[0]) for ids in want.values() for i in ids}
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got.collect()} == sizes
    assert {r.doc_id for r in exact_dedup.survivors(docs).collect()} == {ids[0] for ids in want.values()}


# --- mixing


def test_mix_meets_targets(spark):
    rnd = random.Random(1)
    docs = brute.documents(spark, [(i, "w " * rnd.randint(0, 40), "en", rnd.choice(["a", "a", "a", "b", None, "z"])) for i in range(400)])
    got = mixing.mix(docs).toPandas().merge(docs.select("doc_id", "source").toPandas(), on="doc_id")
    for _, g in got.groupby(got.source.fillna("~")):
        assert g.taken.sum() == int(np.floor(g.target.iloc[0]))
        assert g["size"].sum() == g.source_size.iloc[0]
    assert (got.taken <= 3 * got["size"]).all()
    assert got.groupby(got.source.fillna("~")).target.first().sum() == pytest.approx(got["size"].sum())
    assert rows(mixing.mix(docs)) == rows(mixing.mix(docs))


def test_cut_is_the_same_by_ranges_of_any_size(spark, duck, monkeypatch):
    """Many digits of the key make many ranges; the cut is narrowed by steps to the same key."""
    for most in (5, 0.01):
        monkeypatch.setattr(mixing, "RANGE_ROWS", most)
        assert_same(queries.op5_mix_sources(spark, TINY), duck, mixing.ORACLE)


def test_mix_edge_values(spark):
    """Null, blank and very long texts, null ids and sources, repeated rows and clashing names: whole words of each target."""
    rows_ = [(1, None, "en", "a"), (2, " \n", "en", "a"), (3, "w " * 50_000, "en", "a"), (None, "a b c d", None, None), (4, "a b", "en", "b"), (4, "a b", "en", "b"), (5, "", "en", "empty")]
    docs = brute.documents(spark, rows_).withColumns({c: F.lit("x") for c in ("size", "target", "taken", "source_size", "a.b")})
    got = sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    # weights a 5, b 2, empty 1, null 5: b, empty and null stop at three times their words, a takes the rest
    left = 50_008 - 3 * 4 - 3 * 4
    want = [(1, 0, 50_000, float(left), 0), (2, 0, 50_000, float(left), 0), (3, 50_000, 50_000, float(left), left), (None, 4, 4, 12.0, 12), (4, 2, 4, 12.0, 6), (4, 2, 4, 12.0, 6), (5, 0, 0, 0.0, 0)]
    assert got == sorted(want, key=str)
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_mix_tied_rows(spark):
    same = brute.documents(spark, [(1, "a b c")] * 5 + [(2, "d e f g", "en", "t")])
    got = mixing.mix(same).toPandas()
    assert got["size"].tolist().count(3) == 5 and (got.taken <= 3 * got["size"]).all()


def test_mixed_documents_are_whole(spark):
    docs = brute.documents(spark, [(i, "w " * (i % 9 + 1), "en", "abc"[i % 3]) for i in range(300)])
    back = mixing.mixed_documents(docs)
    assert back.columns == docs.columns
    text = {r.doc_id: r.text for r in docs.collect()}
    got = back.collect()
    assert all(text[r.doc_id] == r.text for r in got)
    assert max(Counter(r.doc_id for r in got).values()) <= 3


# --- packing


def test_ids_are_the_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = ["", "Hello  world\n\n x", "Ünïcödé 中文 𝔸", "a" * 5000, "<|endoftext|> is text", " \t\r\n", "it's 12345 ++"] + [r.text for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    for text, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert packing.document_ids(text).tolist() == [*e.ids, packing.END_ID]


def test_document_ids_are_the_tokenizers_by_default(spark):
    """Default settings: an added token's string has its own id; white space without end is no failure."""
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext| >", "", " \t\r\n", " " * 1_000_001 + "x", "\n" * 1_000_001, "Ünïcödé 中文 𝔸"]
    want = [[*t.encode(x, add_special_tokens=False).ids, packing.END_ID] for x in texts]
    assert want[0] == [64, 220, 50256, 275, packing.END_ID]
    for text, ids in zip(texts, want):
        assert packing.document_ids(text).tolist() == ids
    got = packing.pack(brute.documents(spark, list(enumerate(texts))))
    for i, (n, crc) in {r.doc_id: (r.length, r.ids_crc32) for r in got.where("start = 0").collect()}.items():
        assert n == (len(want[i]) - 1) % packing.CAPACITY + 1 and crc == zlib.crc32(np.array(want[i][:n], "<u4").tobytes())
    assert {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == {i: len(x) for i, x in enumerate(want)}


def test_pack_is_gapless_and_whole(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").unionByName(edges(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    got = packing.pack(docs).toPandas()
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == np.r_[0, g.length.cumsum().iloc[:-1]].tolist() and g.length.sum() <= packing.CAPACITY
    by = {}
    for r in docs.collect():
        by.setdefault(r.doc_id, []).append(packing.document_ids(r.text))
    for d, ids in by.items():
        own = got[got.doc_id == d] if d is not None else got[got.doc_id.isna()]
        want = Counter()
        for x in ids:
            first = len(x) % packing.CAPACITY or packing.CAPACITY
            cuts = [0, *range(first, len(x) + 1, packing.CAPACITY)]
            want.update((k, s, e - s, zlib.crc32(x[s:e].tobytes())) for k, (s, e) in enumerate(zip(cuts, cuts[1:])))
        assert Counter(zip(own.piece, own.start, own.length, own.ids_crc32)) == want
    full = got.length.sum() / packing.CAPACITY
    assert got.sequence_id.nunique() <= max(1.05 * full, np.ceil(full) + 3)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 30), max_size=20))
def test_plan_holds_every_piece(counts):
    got = Counter()
    total = 0
    for lengths, m in packing.plan(counts, 32):
        assert m > 0 and sum(lengths) <= 32
        total += m
        for n in lengths:
            got[n] += m
    assert got == counts
    need = sum(n * c for n, c in counts.items())
    assert total <= 1.25 * -(-need // 32) + sum(c for n, c in counts.items() if n > 16) + 1


def test_plan_uses_exact_complements():
    assert sum(m for _, m in packing.plan({700: 5, 324: 5, 512: 4, 600: 2, 200: 2, 224: 2})) == 9


# --- n-gram join


def mutated(rnd, base, n):
    w = base.split()
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed):
    """A large group of near copies, chains at the threshold, a passage that many share, short and equal texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    bases = [text(rnd.choice((8, 30, 60, 120))) for _ in range(12)]
    passage = text(40)
    made = [mutated(rnd, bases[0] if i % 3 else rnd.choice(bases), rnd.randrange(4)) for i in range(260)]
    made += [f"{passage} {text(rnd.choice((3, 8, 12, 40)))}" for _ in range(60)]
    made += ["", None, "a b", "A B", "a b c", "one two three four five", "ONE two three four five"] + made[:10]
    docs = [(i * 3 + 1, t) for i, t in enumerate(made)]
    rnd.shuffle(docs)
    got = ngram_join.similar_groups(brute.documents(spark, docs).repartition(5))
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.similar(docs), key=str)


def test_join_edges(spark):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.similar_groups(edges(spark)).collect()}
    assert got[1, 0] == 1 and got[2, 0] == 2 and got[3, 0] == 3 and got[7, 2] == 6 and got[4, 1] == 4
    assert got[5, 3] == 5
    keep = ngram_join.representatives(edges(spark))
    assert keep.columns == edges(spark).columns and {1, 2, 3, 4, 5, 6, 8} <= {r.doc_id for r in keep.collect()}


def test_bound_grows_with_size():
    n = np.arange(1, 200_000)
    spare = ngram_join.least_overlap(n) - ngram_join.extra(n)
    assert (np.diff(spare) >= -1).all() and (np.maximum.accumulate(spare) - spare <= 1).all()


def test_search_connects_what_all_pairs_connect():
    rnd = random.Random(5)
    for _ in range(30):
        base = rnd.sample(range(400), 60)
        sets = [np.array(sorted(set(rnd.sample(base, rnd.randint(30, 60)) + rnd.sample(range(400), rnd.randint(0, 12)))), np.uint64) for _ in range(25)]
        sizes = [len(s) + rnd.randrange(3) for s in sets]

        def parts(links):
            label = list(range(len(sets)))
            for i, j in links:
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
            return {frozenset(i for i in range(len(sets)) if label[i] == x) for x in label}

        every = [(i, j) for i in range(25) for j in range(i) if ngram_join.linked(len(set(sets[i]) & set(sets[j])), sizes[i], sizes[j])]
        assert parts(ngram_join.search(sets, sizes, list(range(25)))) == parts(every)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abAB \n\t\x0bé中", max_size=60), max_size=6))
def test_shingle_sets_have_the_right_size(texts):
    import pyarrow as pa

    for _, _, data, offsets in textbytes.slices(pa.array(texts, pa.string()), 1 << 20):
        assert [len(s) for s in textbytes.shingle_sets(data, offsets, 5)] == [len(brute.shingles(t)) for t in texts]


# --- quality rules


@settings(max_examples=5, deadline=None)
@given(st.data())
def test_repeated_words(spark, data):
    texts = data.draw(st.lists(st.text("ab c\n", max_size=40), min_size=1, max_size=12))
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.with_features(brute.documents(spark, list(enumerate(texts))), "doc_id").collect()}
    for i, t in enumerate(texts):
        w = brute.words(t)
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        assert got[i] == len({k + j for k, g in enumerate(grams) if g in twice for j in range(3)})


# --- language


def test_language_scores_equal_plain_sums():
    texts = [("de", "der hund und die katze"), ("fr", "le chien et le chat été"), ("de", "straße und haus")]
    langs, table = language_id.learn(texts, language_id.vocabulary())
    scorer = language_id.Scorer(langs, table)

    def forward(text, k):
        """By exact fractions, so that nothing vanishes."""
        alpha = [Fraction(1)] + [Fraction(0)] * len(text)
        for j in range(1, len(text) + 1):
            for i in range(max(0, j - 40), j):
                p = table.get(text[i:j])
                alpha[j] += alpha[i] * (Fraction(p[k]) if p else Fraction(language_id.UNKNOWN) if i == j - 1 else 0)
        return math.log(alpha[-1].numerator) - math.log(alpha[-1].denominator)

    for text in ["Der Hund", "l'été 12 中文 a𝔸b", "x" * 100, "中文" * 70 + "und", "derhundunddiekatze" * 9, "a" * 31, "a" * 32, "!!! ...", None]:
        total, some = scorer.texts([text])
        parts = [language_id.START + x for w in (text or "").lower().split() if (x := language_id.letters(w))]
        assert some[0] == bool(parts)
        if parts:
            assert total[0] == pytest.approx([sum(forward(p, k) for p in parts) for k in range(len(langs))], rel=1e-9)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.98
    odd = {r.doc_id: r for r in language_id.identify(edges(spark)).collect()}
    assert (odd[1].lang_pred, odd[1].score, odd[3].lang_pred) == ("und", 0.0, "und")


# --- classifier


def test_classifier_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = quality_model.classify(spark.read.parquet(f"{d}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.9
    assert got.score.between(0, 1).all()


def test_classifier_edges(spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (6, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_model.classify(edges(spark), labels).collect()
    assert len(got) == len(EDGES) and all(r.score == 0.5 and r.predicted == 1 for r in got)


def test_repeated_ids_do_not_crowd_out_a_label(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "SAMPLE_ROWS", 200)
    bad = [(i, "### $$$ BUY NOW!!! " * (5 + i % 7)) for i in range(150)]
    good = [(i, "These are plain words, in a calm sentence. " * (5 + i % 7)) for i in range(150, 300)]
    labels = spark.createDataFrame([(i, int(i >= 150), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = quality_model.classify(brute.documents(spark, bad * 4 + good), labels).collect()
    assert len(got) == 750 and all(r.predicted == int(r.doc_id >= 150) for r in got)


def test_statistics_do_not_depend_on_the_batch():
    import pyarrow as pa

    texts = ["One two. Three!", "", "a | b\nc d d d", "Ünï 12 ###"]
    (_, _, data, offsets), = textbytes.slices(pa.array(texts))
    whole = quality_model.statistics(data, offsets)
    for i, t in enumerate(texts):
        (_, _, data, offsets), = textbytes.slices(pa.array([t]))
        assert quality_model.statistics(data, offsets)[0] == pytest.approx(whole[i])


# --- spans


@settings(max_examples=400, deadline=None)
@given(st.text("0123459 -.+@ab(),x%", max_size=50))
def test_personal_base_spans(text):
    assert pii.scan(text, pii.automaton())[0] == brute.personal(text)


def test_personal_added_spans(spark):
    text = "IBAN DE89 3704 0044 0532 0130 00, account no: 12345678 at https://joe:pw@host.org/x"
    base, more = pii.scan(text, pii.automaton())
    assert [text[s:e] for s, e, k in more] == ["DE89 3704 0044 0532 0130 00", "12345678", "https://joe:pw@host.org/x"]
    assert pii.scan("plain words, no data; see http://example.org/page", pii.automaton()) == ([], [])
    got = {r.doc_id: r for r in pii.find_personal_data(edges(spark)).collect()}
    assert got[1].base_sha256 == brute.digest([]) and got[1].spans == ""


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["password", "Token", "API_KEY", "apikey", "secret", " ", "=", ":", '"', "'", "abc123", "AKIA", "ABCDEFGHIJ234567", "deadbeef0123", "ſecret", "toKen", "é", "\n", "x"]), max_size=14).map("".join))
def test_secret_base_spans(text):
    assert secrets.base_spans(text) == brute.secret(text)


def test_secrets_keep_base_and_add_tagged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    for r in docs.collect():
        assert got[r.doc_id].base_sha256 == brute.digest(brute.secret(r.text or ""))
        for span in filter(None, got[r.doc_id].spans.split(",")):
            s, e = map(int, span.split(":")[1:])
            assert 0 <= s < e <= len(r.text)
    clean = [r for r in docs.collect() if not brute.secret(r.text or "")]
    assert sum(bool(got[r.doc_id].spans) for r in clean) <= 0.02 * len(clean)
    odd = {r.doc_id: r for r in secrets.find_secrets(edges(spark)).collect()}
    assert odd[1].spans == odd[3].spans == ""


def test_viterbi_is_the_best_path():
    rnd = np.random.default_rng(3)
    from itertools import product

    for _ in range(20):
        e, t = rnd.normal(size=(5, 3)), rnd.normal(size=(3, 3))
        t[0, 2] = -1e9
        score = lambda p: sum(e[i, x] for i, x in enumerate(p)) + sum(t[a, b] for a, b in zip(p, p[1:])) - (1e9 if p[0] == 2 else 0)
        assert score(secrets.viterbi(e.tolist(), t.tolist())) == pytest.approx(max(map(score, product(range(3), repeat=5))) - e[0, 0] + e[0, 0])


# --- pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<header class="site-header"><p>Site header words, many of them, here.</p></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, and so on, and so on, to serve you.</p></div>
<div id="main"><article><h1>Title &amp; more</h1><p>First paragraph, with commas, and   enough
 words to be counted as text, &eacute;t cetera.<p>Second paragraph <b>bold <i>and</b> more</i>, it goes on, for a while, too.<br>New line.
<blockquote>Quoted, at length, by someone who said many things.</blockquote><div class="ad">Buy, buy, buy now, it is cheap!</div><form><p>Your mail, please, in here.</p></form></article></div>
<aside><p>Related, and other, and further stories, here, there.</p></aside><section id="comments"><p>I, for one, disagree, strongly, with all of it, really.</p></section><footer>&copy; 2020</footer></body></html>"""


def test_article_only():
    assert main_text.main_text(PAGE).split("\n\n") == ["Title & more", "First paragraph, with commas, and enough words to be counted as text, ét cetera.", "Second paragraph bold and more, it goes on, for a while, too. New line.", "Quoted, at length, by someone who said many things."]


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!-- open", "<script>x", "<div><div></p></div>", "</html>", "<a href='x>y"])
def test_odd_pages_do_not_fail(page):
    assert isinstance(main_text.main_text(page), str)


def test_plain_and_deep_pages():
    assert main_text.main_text("just text &lt;b&gt;") == "just text <b>"
    assert main_text.main_text("<div>" * 3000 + "deep text that is long enough, surely, to count" + "</div>" * 3000) == "deep text that is long enough, surely, to count"


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{TINY}/pages.parquet")
    got = {r.page_id: r.text for r in main_text.extract(pages).collect()}
    import html

    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n\n".join(x for x in parts if x)
