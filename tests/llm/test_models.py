"""Language and quality models against plain versions, and their edges; packing's ids and edges."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import language_id, packing, quality_model

# --- language


def _segmentations(text, known, unknown):
    """Every way to cut ``text``, with its probability; a character that no piece holds is unknown."""
    if not text:
        return [([], 1.0)]
    out = []
    for j in range(1, len(text) + 1):
        p = known.get(text[:j], unknown if j == 1 else None)
        if p is not None:
            out += [([text[:j] if text[:j] in known else None, *rest], p * q) for rest, q in _segmentations(text[j:], known, unknown)]
    return out


@pytest.mark.parametrize("short", [language_id.SHORT, 0])
def test_estimation_counts_all_segmentations(monkeypatch, short):
    """Expected counts equal those over all segmentations, by products and by logarithms."""
    monkeypatch.setattr(language_id, "SHORT", short)
    known = {language_id.START: 0.1, "a": 0.2, "b": 0.1, "ab": 0.3, "ba": 0.05, "aba": 0.15, language_id.START + "a": 0.1}
    words = Counter({"abab": 3, "baca": 2, "aaaa": 1})
    want: dict = {}
    for word, n in words.items():
        every = _segmentations(language_id.START + word, known, language_id.UNKNOWN)
        total = sum(q for _, q in every)
        for pieces, q in every:
            for p in filter(None, pieces):
                want[p] = want.get(p, 0.0) + n * q / total
    got = language_id._expected(words, known, 3)
    assert got == pytest.approx(want, rel=1e-9)


def test_a_rare_language_is_learned(spark):
    """Three documents of a language among thousands teach it."""
    rnd = random.Random(2)
    en, fr = "the and of people water house many things were made here with them".split(), "czesc dziekuje prosze jestem szczescie wszystko bardzo dobrze".split()
    make = lambda words, n=40: " ".join(rnd.choice(words) for _ in range(n))
    rows = [(i, make(en), "en") for i in range(2500)] + [(i, make(fr), "pl") for i in range(5000, 5012)]
    got = {r.doc_id: r for r in language_id.identify(brute.documents(spark, rows)).collect()}
    assert sum(got[i].lang_pred == "pl" for i in range(5000, 5012)) == 12
    assert sum(got[i].lang_pred == "en" for i in range(2500)) == 2500


def test_language_edge_values(spark):
    """Nulls, blanks, no letters, words of a hundred thousand letters, ties, repeated rows, clashing names, no labels."""
    rows = [(i, "der hund und die katze sind hier", "de", "s") for i in range(20)] + [(i, "the dog and the cat are here", "en", "s") for i in range(20, 40)]
    odd = [(50, None, "en", "s"), (51, "", "en", None), (52, " 12 !? \n", None, "s"), (53, "derhund" * 20_000, None, "s"), (None, "the cat", None, "s"), (54, "katze", None, "s"), (54, "katze", None, "s")]
    docs = brute.documents(spark, rows + odd).withColumns({c: F.lit("x") for c in ("score", "lang_pred", "h", "share", "a.b")})
    got = sorted(((r.doc_id, r.held_out, r.lang_pred) for r in language_id.identify(docs).where("doc_id IS NULL OR doc_id >= 50").collect()), key=str)
    held = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 4 == 2
    want = [(50, "und"), (51, "und"), (52, "und"), (53, "de"), (None, "en"), (54, "de"), (54, "de")]
    assert got == sorted(((d, held(d), lang) for d, lang in want), key=str)
    assert all(r.lang_pred == "und" and r.score == 0 for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect())
    assert language_id.identify(docs.where("false")).count() == 0


# --- quality


def _plain_grow(x, y, trees=quality_model.TREES):
    """The same boosting, one split at a time over all cuts of every statistic."""
    n, width = len(x), len(x[0])
    share = (sum(y) + 0.5) / (n + 1)
    base = math.log(share / (1 - share))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality_model.BINS + 1)[1:-1])) for f in range(width)]
    raw, out = np.full(n, base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)

        def node(rows, depth):
            if depth == quality_model.DEPTH:
                return quality_model.RATE * g[rows].sum() / (h[rows].sum() + quality_model.L2)
            best = (1e-6, None)
            for f in range(width):
                for e in edges[f]:
                    left = rows[x[rows, f] <= e]
                    right = rows[x[rows, f] > e]
                    if len(left) < quality_model.LEAST_LEAF or len(right) < quality_model.LEAST_LEAF:
                        continue
                    term = lambda r: g[r].sum() ** 2 / (h[r].sum() + quality_model.L2)
                    gain = term(left) + term(right) - term(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, e, left, right))
            if best[1] is None:
                return node(rows, depth + 1)
            f, e, left, right = best[1]
            return (f, e, node(left, depth + 1), node(right, depth + 1))

        tree = node(np.arange(n), 0)
        out.append(tree)
        raw = raw + np.array([_descend(tree, row) for row in x])
    return base, out


def _descend(tree, row):
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] > tree[1] else tree[2]
    return tree


def test_trees_equal_a_plain_version(monkeypatch):
    """Histograms by level and flat arrays give what growing node by node over all cuts gives."""
    monkeypatch.setattr(quality_model, "TREES", 3)
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(240, 4)).round(2)
    y = (x[:, 0] + 0.7 * x[:, 1] * x[:, 2] + 0.4 * rnd.normal(size=240) > 0).astype(float)
    model = quality_model.grow(x, y)
    base, trees = _plain_grow(x, y, 3)
    fresh = rnd.normal(size=(100, 4))
    for data in (x, fresh):
        want = [1 / (1 + math.exp(-(base + sum(_descend(t, row) for t in trees)))) for row in data]
        assert model.score(data) == pytest.approx(want, rel=1e-9)


def test_rows_thrice_teach_as_once(spark, monkeypatch):
    """Every row three times and more labelled rows than the bound: scores stay those of single rows."""
    monkeypatch.setattr(quality_model, "SAMPLE_ROWS", 300)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    once = {r.doc_id: r.score for r in quality_model.classify(docs, labels).collect()}
    thrice = quality_model.classify(docs.unionByName(docs).unionByName(docs), labels.unionByName(labels)).collect()
    assert len(thrice) == 3 * len(once) and all(r.score == once[r.doc_id] for r in thrice)
    known = {r.doc_id: r.quality for r in labels.where("quality IS NOT NULL").collect()}
    held = [(r.predicted, known[r.doc_id]) for r in thrice if r.held_out and r.doc_id in known]
    assert sum(a == b for a, b in held) > 0.9 * len(held)


# --- packing


def _tokens(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)).encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_packing_edge_values(spark):
    """Nulls, blanks, added tokens, very long runs, ties, repeated rows, null ids and clashing names are packed by the tokenizer's ids."""
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "a <|endoftext|> b"), (5, " " * 1_200_000), (6, "x" * 600_000), (7, "Ünïcödé 中文 𝔸"), (7, "Ünïcödé 中文 𝔸"), (None, "no id here"), (8, "lorem ipsum dolor " * 40_000)]
    docs = brute.documents(spark, texts).withColumns({c: F.lit("x") for c in ("piece", "length", "task", "rank", "offset", "a.b")})
    got = packing.pack(docs).toPandas()
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == np.r_[0, g.length.cumsum().iloc[:-1]].tolist() and g.length.sum() <= packing.CAPACITY
    want = Counter()
    for d, text in texts:
        ids = np.array(_tokens(text), "<u4")
        first = len(ids) % packing.CAPACITY or packing.CAPACITY
        cuts = [0, *range(first, len(ids) + 1, packing.CAPACITY)]
        want.update((d, k, s, e - s, zlib.crc32(ids[s:e].tobytes())) for k, (s, e) in enumerate(zip(cuts, cuts[1:])))
    ids = [None if math.isnan(d) else int(d) for d in got.doc_id]
    assert Counter(zip(ids, got.piece, got.start, got.length, got.ids_crc32)) == want
    assert got.sequence_id.nunique() <= np.ceil(got.length.sum() / packing.CAPACITY) + 3
    assert packing.pack(docs.where("false")).count() == 0


def test_long_texts_are_cut_where_no_token_lies_across(spark):
    """Texts of many parts have the tokenizer's ids, added tokens and odd white space around the cuts included."""
    rnd = random.Random(8)
    words = ["a", "I'm", "don't", "x1", "été", "中文", "\n", "  ", "\t", "well,", "<|endoftext|>", "12 345", "--", "Word", "z" * 40]
    for seed in range(3):
        text = rnd.choice(["", " ", "\n"]) + " ".join(rnd.choice(words) for _ in range(80_000))
        assert len(list(packing._parts(text))) > 1 and "".join(packing._parts(text)) == text
        assert packing.document_ids(text).tolist() == _tokens(text)
