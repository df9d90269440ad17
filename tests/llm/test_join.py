"""The n-gram join where groups are large, chained, or share a passage."""

from __future__ import annotations

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import ngram_join


def _same(spark, docs, parts=6):
    got = ngram_join.similar_groups(brute.documents(spark, docs).repartition(parts))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(brute.similar(docs), key=str)


def _words(rnd, n):
    return [f"w{rnd.randrange(5000)}" for _ in range(n)]


def test_a_passage_in_every_document(spark):
    """Every document holds one passage; some are mostly the passage, and near copies hang on it."""
    rnd = random.Random(11)
    passage = _words(rnd, 40)
    made = [passage + _words(rnd, rnd.choice((2, 4, 6, 30, 60))) for _ in range(240)]
    made += [x[:-1] + ["z"] for x in made[:30]]
    _same(spark, [(i, " ".join(x)) for i, x in enumerate(made)])


def test_chains_and_groups_apart(spark):
    """A chain of near copies that leads from text to text, and groups that share rare shingles but no link."""
    rnd = random.Random(12)
    at = _words(rnd, 60)
    chain = []
    for k in range(150):
        at = list(at)
        at[rnd.randrange(len(at))] = f"n{k}"
        chain.append(at)
    parts = [_words(rnd, 12) for _ in range(6)]
    apart = [sum((rnd.choice(parts) for _ in range(3)), []) + _words(rnd, 14) for _ in range(220)]
    docs = [(i, " ".join(x)) for i, x in enumerate(chain + apart + chain[:5])]
    rnd.shuffle(docs)
    _same(spark, docs)


def test_a_hot_shingle_fills_no_range():
    """Of a shingle that all documents have, a task posts one pair however many documents it has."""
    texts = [f"one two three four five x{i}" for i in range(5000)]
    pieces = list(ngram_join._prefix_postings(8, 8)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])))
    posted = [len(a.as_py()) // 8 for b in pieces for bucket, a in zip(b.column(0).to_pylist(), b.column(1)) if bucket < 8]
    counts = [len(a.as_py()) // 8 for b in pieces for bucket, a in zip(b.column(0).to_pylist(), b.column(1)) if bucket >= 8]
    hot = ngram_join.shingle_sets(np.frombuffer(b"one two three four five", np.uint8), np.array([0, 23]), 5)[0]
    keys = np.concatenate([np.frombuffer(a.as_py(), np.uint64) for b in pieces for bucket, a in zip(b.column(0).to_pylist(), b.column(1)) if bucket < 8])
    assert sum(posted) <= 5002 and np.count_nonzero(keys == hot[0]) in (0, 2) and sum(counts) == 5000


def test_edge_values(spark):
    """Nulls, blanks, very long texts, ties, repeated rows, and columns with clashing and dotted names."""
    long = " ".join(f"w{i}" for i in range(60_000))
    docs = [(3, None), (2, ""), (1, " \n\t"), (9, long), (8, long + " end"), (7, "a B c"), (6, "A b C"), (6, "A b C"), (None, "a b c"), (None, None), (5, "x y")]
    got = sorted((tuple(r) for r in ngram_join.similar_groups(brute.documents(spark, docs)).collect()), key=str)
    assert got == sorted([(3, 0, 3), (2, 0, 2), (1, 0, 1), (9, 59_996, 8), (8, 59_997, 8), (7, 1, 6), (6, 1, 6), (6, 1, 6), (None, 1, 6), (None, 0, None), (5, 1, 5)], key=str)
    named = brute.documents(spark, docs).withColumns({c: F.lit("x") for c in ("meta.url", "node", "n_shingles", "component_id", "label", "tokens")})
    kept = ngram_join.representatives(named)
    assert kept.columns == named.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 2, 1, 8, 6, 6, None, None, 5], key=str)
    assert ngram_join.similar_groups(named.where("false")).count() == 0 == ngram_join.representatives(named.where("false")).count()


@pytest.mark.parametrize("seed", [3, 4])
def test_many_small_groups(spark, seed):
    rnd = random.Random(seed)
    made = []
    for _ in range(60):
        base = _words(rnd, rnd.choice((5, 9, 25, 70)))
        for _ in range(rnd.choice((1, 1, 2, 5))):
            x = list(base)
            for _ in range(rnd.randrange(3)):
                x[rnd.randrange(len(x))] = f"e{rnd.randrange(10**6)}"
            made.append(x)
    _same(spark, [(i, " ".join(x)) for i, x in enumerate(made)], 3)


def test_the_rest_of_a_large_group_is_sent_few_times(spark, monkeypatch):
    """Edited copies of one text that stay apart: each document goes to a fixed number of searches, however many copies there are."""
    rnd = random.Random(5)
    base = _words(rnd, 90)
    made = []
    for i in range(400):
        x = list(base)
        for k in rnd.sample(range(90), 1 if i % 2 else 5):
            x[k] = f"e{rnd.randrange(3)}"
        made.append(x)
    docs = [(i, " ".join(x)) for i, x in enumerate(made)]
    sent, blocks = [], ngram_join._blocks
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "_blocks", lambda rows: sent.append(rows.count()) or blocks(rows))
    _same(spark, docs)
    assert len(sent) == 2 and 0 < sent[1] <= 2 * 16 * 400
