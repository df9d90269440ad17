"""The corpus pipeline against plain Python, stage by stage."""

from __future__ import annotations

from collections import Counter

import brute
import corpus_pipeline
from cohortspark.llm import common, packing, quality_rules
from pyspark.sql import functions as F

TINY = "/root/testdata/sf0.001"


def ids(df):
    return {r.doc_id for r in df.collect()}


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)
    verdict = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    good = stage["quality rules"](spark, docs, TINY)
    assert ids(good) == {d for d, k in verdict.items() if k} and good.columns == docs.columns
    one = stage["exact dedup"](spark, good, TINY)
    groups: dict = {}
    for d in ids(good):
        groups.setdefault("".join(text[d].split()), []).append((-len(text[d]), d))
    assert ids(one) == {min(g)[1] for g in groups.values()} and one.columns == docs.columns
    apart = stage["n-gram join"](spark, one, TINY)
    assert ids(apart) == {c for _, _, c in brute.similar([(d, text[d]) for d in ids(one)])} and apart.columns == docs.columns
    mixed = stage["mixing"](spark, apart, TINY)
    assert mixed.columns == docs.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= ids(apart) and max(copies.values()) <= 3
    packed = stage["packing"](spark, mixed, TINY).collect()
    assert sum(r.length for r in packed) == sum(n * len(packing.document_ids(text[d])) for d, n in copies.items())


def test_run_is_all_stages(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TINY)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, docs.select(columns).collect())) == sorted(map(tuple, corpus_pipeline.run(spark, TINY).select(columns).collect()))


LONG = " ".join(f"w{i}" for i in range(30_000))
SAME = " ".join(f"x{i}" for i in range(70))
ODD = [(1, None, "en", "s"), (2, "", None, "s"), (3, " \n", "en", None), (4, LONG, "en", "s"), (5, SAME, "en", "s"), (5, SAME, "en", "s"), (6, SAME + " ", "en", None), (7, SAME + " end", "en", "s"), (None, LONG + " more", None, None), (8, "too few words", "en", "s")]


def odd(spark):
    """Nulls in every column, blanks, very long texts, ties, repeated rows, and names that clash with inner ones."""
    names = ("node", "label", "kept", "norm", "row", "target", "size", "piece", "length", "n_words", "lo", "h", "rank", "meta.url")
    return brute.documents(spark, ODD).withColumns({c: F.lit("x") for c in names})


def listed(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_every_stage_bears_odd_rows(spark):
    docs, stage = odd(spark), dict(corpus_pipeline.STAGES)
    rows = lambda *ids: sorted(((r[0], r[1]) for r in ODD if r[0] in ids), key=str)
    good = stage["quality rules"](spark, docs, TINY)
    assert listed(good) == rows(4, 5, 6, 7, None) and good.columns == docs.columns
    one = stage["exact dedup"](spark, docs, TINY)
    assert listed(one) == sorted([(3, " \n"), *rows(4, 6, 7, 8, None)], key=str) and one.columns == docs.columns
    apart = stage["n-gram join"](spark, docs, TINY)
    assert listed(apart) == rows(1, 2, 3, 4, 5, 8, None) and apart.columns == docs.columns
    mixed = stage["mixing"](spark, docs, TINY)
    assert mixed.columns == docs.columns and set(listed(mixed)) <= {(r[0], r[1]) for r in ODD}
    assert max(Counter(d for d, _ in listed(mixed)).values()) <= 6  # of the row that comes twice
    packed = stage["packing"](spark, docs, TINY).collect()
    assert sum(r.length for r in packed) == sum(len(packing.document_ids(r[1])) for r in ODD)


def test_every_stage_bears_an_empty_table(spark):
    none = odd(spark).where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, TINY)
        assert out.count() == 0 and (name == "packing" or out.columns == none.columns)


def test_run_bears_odd_rows_and_leaves_little(spark, tmp_path):
    """The whole run on odd rows; of the tables that it wrote only the last stage's stay."""
    odd(spark).write.parquet(f"{tmp_path}/documents.parquet")
    before = len(common._written)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    left = {path.rsplit("/", 1)[1].rsplit("-", 1)[0] for _, path in common._written[before:]}
    assert left <= {"pipeline-3", "pack-pieces", "pack-counts"}
    docs = odd(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got))) == sorted(map(str, map(tuple, docs.select(columns).collect())))
    odd(spark).where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
