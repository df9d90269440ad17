"""Best-fit packing of tokenised documents into sequences of a fixed length.

Pieces are packed by their lengths alone: at most ``capacity`` different ones, so the
plan is made from a histogram of bounded size however many pieces there are. Exact
complements come first: for each length, longest first, the index of available single,
pair and triple sums names combinations that fill its gap without waste, consumed as
often as their counts allow; best fit decreasing places what is left. The plan gives
ranges of ranks within each length; a piece learns its rank from its task's own counts
and prefix sums over tasks, and so its sequence and place without any regrouping.

The ids are those of ``tokenizers`` on the named file with ``add_special_tokens=False``:
nothing is put around a text, but an added token's string within it gets its own id. Texts
that hold no such string go through a merger over that file's own vocabulary (equal ids,
tested, at a quarter of the time and a fraction of the memory), others through
``tokenizers`` itself; long ones in parts, cut where no token can lie across, and a part
of ``LONG`` characters without such a place through ``tokenizers``. Null text is empty: one piece that holds only the end id. Repeated
rows are packed each; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import bounded_batches, freeing, materialise

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: The merger's pattern fails on about 1,000,000 white-space characters in a row; texts from this length on never reach it.
LONG = 500_000
PART = 100_000
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank_in_task long"


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
    of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(of[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _path(name: str) -> str:
    import public_tokenizers

    return name if "/" in name else public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def _added(path: str) -> tuple[str, ...]:
    """The strings of the tokenizer's added tokens."""
    with open(path, encoding="utf-8") as f:
        return tuple(t["content"] for t in json.load(f).get("added_tokens", []))


@functools.lru_cache(maxsize=2)
def _contract(path: str):
    """The tokenizer itself."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _parts(text: str) -> Iterator[str]:
    """``text`` in parts of about ``PART`` characters, cut before a space between two letters.

    No token holds such a place but at its start, so the parts' ids are the text's.
    """
    low = 0
    while len(text) - low > PART and (m := _CUT.search(text, low + PART)):
        yield text[low : m.start()]
        low = m.start()
    yield text[low:]


def document_ids(text: str | None, tokenizer: str = TOKENIZER) -> np.ndarray:
    """The ids of one document, the end id included."""
    ids = []
    for part in _parts(text or ""):
        if len(part) < LONG and not any(a in part for a in _added(_path(tokenizer))):
            ids.append(np.array(_encoder(_path(tokenizer)).encode_ordinary(part), dtype="<u4"))
        else:
            ids.append(np.array(_contract(_path(tokenizer)).encode(part, add_special_tokens=False).ids, dtype="<u4"))
    return np.concatenate([*ids, np.array([END_ID], "<u4")])


def _pieces(capacity: int, tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            docs, texts = b.column(0), b.column(1)
            at, nr, start, length, crc = [], [], [], [], []
            for i in range(b.num_rows):
                ids = document_ids(texts[i].as_py(), tokenizer)
                n = len(ids)
                k = -(-n // capacity)
                s, e = 0, n - (k - 1) * capacity
                for j in range(k):
                    at.append(i)
                    nr.append(j)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(ids[s:e].tobytes()))
                    s, e = e, e + capacity
            n = np.array(length, np.int64)
            order = np.argsort(n, kind="stable")
            of = n[order]
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
            count = np.diff(np.r_[first, len(of)])
            rank = np.empty(len(of), np.int64)
            rank[order] = np.arange(len(of)) - np.repeat(first, count) + seen[of]
            seen[of[first]] += count
            yield pa.RecordBatch.from_arrays(
                [docs.take(pa.array(at, pa.int64())).cast(pa.int64()), pa.array(nr, pa.int32()), pa.array(start, pa.int64()), pa.array(n), pa.array(crc, pa.int64()), pa.array(np.full(len(n), task, np.int32)), pa.array(rank)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank_in_task"],
            )

    return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence, number of such sequences) that hold all pieces.

    A pair or triple that fills one gap can leave long pieces without their best partner,
    so exact sums of up to one, two and three pieces are tried, each behind every length
    or only behind those over half a sequence; the plan with the fewest sequences is taken.
    """
    tried = (_plan(counts, capacity, low, most) for most in (3, 2, 1) for low in (0, capacity // 2))
    return min(tried, key=lambda p: sum(m for _, m in p))


def _plan(counts: dict[int, int], capacity: int, low: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    out: list[tuple[tuple[int, ...], int]] = []

    def times(lengths: tuple[int, ...]) -> int:
        return min(int(left[x]) // lengths.count(x) for x in set(lengths))

    def take(lengths: tuple[int, ...]) -> bool:
        if (m := times(lengths)) < 1:
            return False
        for x in lengths:
            left[x] -= m
        out.append((lengths, m))
        return True

    if left[capacity]:
        take((capacity,))
    here = left[:capacity] > 0
    pairs = np.convolve(here, here) > 0  # sums of two available lengths; refreshed when a length runs out

    def refresh() -> None:
        nonlocal here, pairs
        now = left[:capacity] > 0
        if (now != here).any():
            here = now
            pairs = np.convolve(here.astype(np.int32), here.astype(np.int32)) > 0

    def pair_of(total: int) -> Iterator[tuple[int, int]]:
        a = np.arange((total + 1) // 2, total)
        for x in a[here[a] & here[total - a]]:
            yield int(x), int(total - x)

    def fill(n: int, more: int) -> bool:
        """Fills the gap behind ``n`` with ``more`` pieces, as often as one combination allows."""
        gap = capacity - n
        if more == 1:
            return bool(here[gap]) and take((n, gap))
        if more == 2:
            return bool(pairs[gap]) and any(take((n, *p)) for p in pair_of(gap))
        a = np.arange(gap - 2, 0, -1)
        return any(take((n, int(x), *p)) for x in a[here[a] & pairs[gap - a]] for p in pair_of(int(gap - x)))

    refresh()
    for more in range(1, most + 1):  # all single complements first: a piece spent in a pair leaves its own complement alone
        for n in range(capacity - 1, low, -1):
            while left[n] and capacity - n >= more and fill(n, more):
                refresh()
    open_at: list[list[list]] = [[] for _ in range(capacity + 1)]  # by room left: [lengths, number]
    for n in range(capacity - 1, 0, -1):
        c = int(left[n])
        while c:
            room = next((r for r in range(n, capacity) if open_at[r]), None)
            if room is None:
                fits = capacity // n
                for per, m in ((fits, c // fits), (c % fits, 1)):
                    if per and m:
                        open_at[capacity - per * n].append([(n,) * per, m])
                break
            kind = open_at[room][-1]
            m = min(c, kind[1])
            kind[1] -= m
            if not kind[1]:
                open_at[room].pop()
            open_at[room - n].append([(*kind[0], n), m])
            c -= m
    out += [(k[0], k[1]) for kinds in open_at for k in kinds]
    return out


def _segments(patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[str, np.ndarray]:
    """By length and first rank: which sequences the ranks of that length go to, and where there."""
    used, rows, base = np.zeros(capacity + 1, np.int64), [], 0
    for lengths, m in patterns:
        offset = 0
        for n in lengths:
            rows.append((n, used[n], base, offset))
            used[n] += m
            offset += n
        base += m
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return {"key": (cols[0] << 48) + cols[1], "rank": cols[1], "sequence": cols[2], "offset": cols[3]}


def _placed(seg: dict[str, np.ndarray], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(seg["key"], (n << 48) + rank, side="right") - 1
            cols = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seg["sequence"][at] + rank - seg["rank"][at]), pa.array(seg["offset"][at])], names=[*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per piece of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    made = bounded_batches(docs).select("doc_id", "text").mapInArrow(freeing(_pieces(capacity, tokenizer)), PIECES)
    pieces = materialise(made, "pack-pieces")
    by_task = materialise(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "pack-counts")
    histogram = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()  # capacity rows at most
    seg = _segments(plan({r["length"]: r["n"] for r in histogram}, capacity), capacity)
    before = F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    base = by_task.select("task", "length", F.coalesce(before, F.lit(0)).alias("base"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # a row per task and length grows with the input, so it is joined by shuffle at any size
    ranked = pieces.join(base.hint("shuffle_hash"), ["task", "length"]).select(*names, (F.col("base") + F.col("rank_in_task")).alias("rank"))
    return ranked.mapInArrow(_placed(seg, names), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
