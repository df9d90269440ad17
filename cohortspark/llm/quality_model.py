"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics (``STATISTICS``) are counted on the bytes of a batch at once. Trees are
grown on the driver from at most ``SAMPLE_ROWS`` labelled rows (those with the smallest
hash of their id among the rows that are not held out), on quantile bins, and flattened
to arrays by level, so a batch descends one level of one tree in one vector operation.

Null text counts as empty and is scored like any other. Labels that are null or not 0/1,
and repeated labels of a document that disagree, teach nothing. Without labels of both
kinds every score is the share of label 1 (0.5 without labels). Repeated rows are scored
each, but an id teaches once, by its row with the least statistics; an empty table gives
an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, remainder
from .textbytes import mixed, slices, word_bounds, word_hashes

MODULUS = 5
CUT = 0.3
SAMPLE_ROWS = 20_000
BINS, DEPTH, TREES, RATE, LEAST_LEAF, L2 = 64, 4, 80, 0.15, 20, 1.0

#: Bytes whose share is a statistic.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".?",
    "comma": b",;:",
    "bang": b"!",
    "bar": b"|",
    "mark": b"#*$%&<>@~^=+/\\_{}[]",
    "quote": b"\"'()-",
    "line": b"\n",
    "other": bytes(range(128, 256)),
}
STATISTICS = [*CLASSES, "bytes", "words", "word_mean", "word_sd", "word_most", "title", "ends_stop", "ends_mark", "distinct", "pairs", "triples", "per_stop", "per_line"]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of statistics per text."""
    rows = len(offsets) - 1

    def share(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        run = np.concatenate([np.zeros(1), np.cumsum(flags, dtype=np.float64)])
        return run[cuts[1:]] - run[cuts[:-1]]

    size = np.diff(offsets).astype(float)
    tables = {k: np.isin(np.arange(256), list(v)) for k, v in CLASSES.items()}
    counts = {k: share(t[data], offsets) for k, t in tables.items()}
    starts, ends, row = word_bounds(data, offsets)
    cuts = np.searchsorted(row, np.arange(rows + 1))
    n = np.diff(cuts).astype(float)
    one, some = np.maximum(n, 1), np.maximum(size, 1)
    length = (ends - starts).astype(float)
    mean = share(length, cuts) / one
    most = np.zeros(rows)
    np.maximum.at(most, row, length)
    end = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    begin = data[starts] if len(starts) else end
    h = word_hashes(data, starts, ends, lower=False)
    pairs = mixed(h[:-1] * np.uint64(3) + h[1:])
    grams = [h, pairs, mixed(pairs[:-1] * np.uint64(7) + h[2:])]
    distinct = np.ones((3, rows))
    for i in range(rows):
        for k, g in enumerate(grams):
            own = g[cuts[i] : max(cuts[i], cuts[i + 1] - k)]
            if len(own) > 1:
                own = np.sort(own)
                distinct[k, i] = (1 + np.count_nonzero(own[1:] != own[:-1])) / len(own)
    columns = [counts[k] / some for k in CLASSES]
    columns += [np.log1p(size), np.log1p(n), mean, np.sqrt(np.maximum(0, share(length**2, cuts) / one - mean**2)), np.log1p(most)]
    columns += [share(tables["upper"][begin], cuts) / one, share(tables["stop"][end], cuts) / one, share(tables["mark"][end] | tables["bang"][end] | tables["bar"][end], cuts) / one]
    columns += [*distinct, n / (1 + counts["stop"]), n / (1 + counts["line"])]
    return np.stack(columns, axis=1)


class Trees:
    """Boosted trees in flat arrays: split statistic and value by tree and node, leaf values by tree."""

    def __init__(self, base: float, split: np.ndarray, value: np.ndarray, leaf: np.ndarray) -> None:
        self.base, self.split, self.value, self.leaf = base, split, value, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        every = np.arange(len(x))
        for split, value, leaf in zip(self.split, self.value, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[every, split[node]] > value[node])
            total += leaf[node - len(split)]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees fitted to the logistic loss; each level's histograms are summed in one pass."""
    n, width = x.shape if len(x) else (0, len(STATISTICS))
    share = (y.sum() + 0.5) / (n + 1)
    inner = 2**DEPTH - 1
    none = Trees(float(np.log(share / (1 - share))), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if n < 2 * LEAST_LEAF or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    at = binned + np.arange(width) * BINS
    raw, splits, values, leaves = np.full(n, none.base), [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        split, value, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, many = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (width * BINS) + at).ravel()
            hist = [np.bincount(cell, np.repeat(w, width), many * width * BINS).reshape(many, width, BINS).cumsum(axis=2) for w in (g, h, np.ones(n))]
            gl, hl, nl = hist
            gt, ht, nt = (a[:, :, -1:] for a in hist)
            gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
            gain[(nl < LEAST_LEAF) | (nt - nl < LEAST_LEAF)] = 0
            best = gain.reshape(many, -1).argmax(axis=1)
            for k in range(many):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    split[first + k], value[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), split[node]] > value[node])
        spot = node - inner
        leaf = RATE * np.bincount(spot, g, inner + 1) / (np.bincount(spot, h, inner + 1) + L2)
        raw += leaf[spot]
        splits.append(split)
        values.append(value)
        leaves.append(leaf)
    return Trees(none.base, np.array(splits), np.array(values), np.array(leaves))


def _of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches whose last column is the text, with their statistics."""
    for b in batches:
        for i, j, data, offsets in slices(b.column(b.num_columns - 1)):
            yield b.slice(i, j - i), statistics(data, offsets)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b, x in _of_batches(batches):
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1).cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _of_batches(batches):
            s = model.value.score(x)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1), pa.array(s), pa.array((s >= CUT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    held = (remainder(F.col("doc_id"), MODULUS) == 0).alias("held_out")
    y = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), MODULUS) != 0))
    y = y.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z")
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS).select("doc_id", "y")
    seen = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id").select("doc_id", "y", "text").mapInArrow(_statistics, "doc_id long, y int, x array<double>")
    one = seen.groupBy("doc_id", "y").agg(F.min("x").alias("x"))  # SAMPLE_ROWS rows at most
    rows = sorted(one.collect(), key=lambda r: (r["y"], r["x"]))  # in an order that reruns keep
    trees = grow(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float))
    model = docs.sparkSession.sparkContext.broadcast(trees)
    return bounded_batches(docs).select("doc_id", held, "text").mapInArrow(_scores(model), "doc_id long, held_out boolean, score double, predicted int")
