"""Exact duplicates by content sort.

Rows are range-partitioned by sampled splitters on the normalised text (white space
deleted) and sorted externally, so equal texts are adjacent. Splitters carry the first
``LEAD`` bytes and a 64-bit hash of the text, with length and id behind them: they stay
small for any text, and a group of copies of any size is dealt over many partitions.
Each partition then compares full neighbours; a run of equal texts that touches an end
of its partition is joined to the runs of the same digest at other ends (at most two per
partition). The row with the longest original text, then the smallest id, comes first
in its group and stays.

Null text counts as empty; null ids sort last; of rows alike in everything one stays.
An empty table gives an empty table. Other columns pass through ``survivors`` unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, bounded_batches, freeing, materialise, partitions, small

LEAD = 64
OUT = "doc_id long, text_sha256 string, run_keep long, run_size long, run_pid int, run_first boolean, run_edge boolean"


def _sorted(docs: DataFrame, with_row: bool) -> DataFrame:
    """doc_id, norm (and row): range-partitioned and sorted. A row that is carried holds its text, so only that is moved."""
    plain = lambda text: F.encode(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, ""), "UTF-8")
    held = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row") if with_row else plain(F.col("text")).alias("norm")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length(F.coalesce("text", F.lit(""))).alias("n"), held)
    bounded_batches(docs)
    norm = plain(F.col("row.text")) if with_row else F.col("norm")
    tail = [F.col("n").desc(), F.col("doc_id").asc_nulls_last()]
    dealt = d.select("*", F.substring(norm, 1, LEAD).alias("lead"), F.xxhash64(norm).alias("h")).repartitionByRange(partitions(docs.sparkSession), "lead", "h", *tail)
    return (dealt.withColumn("norm", norm) if with_row else dealt).sortWithinPartitions("lead", "h", "norm", *tail)


def _digest(norm: pa.Array, i: int) -> str:
    return hashlib.sha256(norm[i].as_buffer()).hexdigest()


def _runs(only_first: bool):
    """Arrow batches of a sorted partition to its rows with their runs; of each run the first row only, if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        names = ["doc_id", "text_sha256", "run_keep", "run_size", "run_pid", "run_first", "run_edge"] + ["row"] * only_first

        def rows(ids: pa.Array, size: np.ndarray, sha: list[str], edge: bool, row: pa.Array | None) -> pa.RecordBatch:
            """Runs with ``size`` rows each: all their ids, or the first ones with their rows."""
            first = np.cumsum(size) - size
            if only_first:
                keep, each = ids, np.ones(len(size), np.int64)
            else:
                keep, each = ids.take(pa.array(first)), size
            n = int(each.sum())
            head = np.zeros(n, bool)
            head[np.cumsum(each) - each] = True
            at = pa.array(np.repeat(np.arange(len(size)), each))
            cols = [ids, pa.array(sha, pa.string()).take(at), keep.take(at), pa.array(np.repeat(size, each)), pa.array(np.full(n, pid, np.int32)), pa.array(head), pa.array(np.full(n, edge))]
            return pa.RecordBatch.from_arrays(cols + [row] * only_first, names=names)

        last, sha, row, ids, count, closed = None, "", None, [], 0, 0  # of the run that is open

        def close(end: bool) -> pa.RecordBatch:
            own = pa.chunked_array(ids, pa.int64()).combine_chunks()
            return rows(own.slice(0, 1) if only_first else own, np.array([count]), [sha], end or closed == 0, row)

        for b in batches:
            if not (n := b.num_rows):
                continue
            norm, doc = b.column("norm"), b.column("doc_id")
            same = np.zeros(n, bool)
            same[1:] = pc.equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            same[0] = last is not None and norm[0].as_py() == last
            starts = np.flatnonzero(~same)
            lead = int(starts[0]) if len(starts) else n
            if lead:
                count += lead
                if not only_first:
                    ids.append(doc.slice(0, lead))
            if len(starts):
                if count:
                    yield close(False)
                    closed += 1
                inner, s, e = starts[:-1], int(starts[0]), int(starts[-1])
                if len(inner):
                    if closed == 0:  # the partition's first run is an end of it
                        k = int(starts[1])
                        yield rows(doc.slice(s, 1 if only_first else k - s), np.array([k - s]), [_digest(norm, s)], True, b.column("row").take(pa.array([s])) if only_first else None)
                        inner, s = inner[1:], k
                    if len(inner):
                        size = np.diff(np.r_[inner, e])
                        at = pa.array(inner)
                        yield rows(doc.take(at) if only_first else doc.slice(s, e - s), size, [_digest(norm, int(i)) for i in inner], False, b.column("row").take(at) if only_first else None)
                    closed += len(starts) - 1
                sha, count = _digest(norm, e), n - e
                ids = [doc.take(pa.array([e]))] if only_first else [doc.slice(e)]
                row = b.column("row").take(pa.array([e])) if only_first else None
            last = norm[n - 1].as_py()
        if count:
            yield close(True)

    return run


def _resolved(runs: DataFrame) -> DataFrame:
    """``runs`` with keep_id, group_size and kept; runs at ends of partitions are joined by digest."""
    ends = runs.where("run_edge AND run_first").groupBy(F.col("text_sha256").alias("end_sha")).agg(F.min(F.struct("run_pid", "run_keep")).alias("best"), F.sum("run_size").alias("n"))
    joined = runs.join(small(ends), F.col("run_edge") & (F.col("text_sha256") == F.col("end_sha")), "left").drop("end_sha")
    return joined.withColumns({
        "keep_id": F.when(F.col("run_edge"), F.col("best.run_keep")).otherwise(F.col("run_keep")),
        "group_size": F.when(F.col("run_edge"), F.col("n")).otherwise(F.col("run_size")),
        "kept": F.col("run_first") & (~F.col("run_edge") | (F.col("run_pid") == F.col("best.run_pid"))),
    })


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    runs = materialise(_sorted(docs, False).select("doc_id", "norm").mapInArrow(freeing(_runs(False)), OUT), "exact-runs")
    return _resolved(runs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    schema = T._parse_datatype_string(OUT).add("row", docs.schema)
    runs = materialise(_sorted(docs, True).select("doc_id", "norm", "row").mapInArrow(freeing(_runs(True)), schema), "exact-runs")
    return _resolved(runs).where("kept").select("row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER o AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, row_number() OVER o = 1 AS kept, text_sha256
FROM d WINDOW o AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
