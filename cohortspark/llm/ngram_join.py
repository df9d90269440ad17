"""Similarity self-join on word shingles by T-occurrence search.

Two documents link when their sets of five-word shingles have a Jaccard similarity of
0.75 or more. Exact, with shingles as 64-bit hashes and equal sets as one node.

1. Bound. In any fixed order of shingles, documents with a large enough overlap share about
   ``l`` of their first ``|x| - ceil(0.75|x|) + l`` shingles. Postings of those
   prefixes (hash order) are sent to ranges of hash space as packed arrays, as many as
   the input's size asks for, and a document goes on only if enough of its prefix occurs
   elsewhere. A task counts the shingles that two of its own documents have by itself
   and sends each once, so a shingle of very many documents fills no range. Survivors are
   marked in a Bloom filter of fixed size (false marks cost time, not results).
2. Blocks. Among the survivors every shingle is counted exactly: a document needs enough
   shingles that others have, and with the rarest first a prefix of those, often one or
   two, must meet any partner's. Documents that share a prefix shingle form a group,
   searched whole; one of more than ``BLOCK`` documents is dealt into blocks, each with
   the same few pivots of the group: those whose shingles most others have, so that the
   original of many edited copies is one.
3. Search. In a block, each document queries the inverted lists of those before it: the
   long lists are set aside, the short ones heap-merged, and candidates probed in the long
   ones (DivideSkip; a block's lists being short, all probes of a candidate are one
   operation on bit sets). Documents already connected need no further probe.
4. Rest. Where the blocks of a group stay apart, the documents outside the group's
   largest part are dealt into chunks, and a chunk is searched against those members of
   the group that share a prefix shingle with it, block by block: a group that hangs
   together by a chain of shared shingles costs what its links of the chain cost. A chunk
   whose shingles' lists add up to the group or more is searched against the group. The
   blocks and chunks of this step grow with the group, up to ``TILE_TOKENS`` shingles, so
   a document is sent to some ``TILES`` searches however large its group.

Null and blank texts have no set and no link. Repeated rows and equal sets form one
component. A component's id is its smallest doc_id; null ids are passed over. An empty
table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, discard, discard_since, freeing, materialise, partitions, tasks_for, written
from .components import connected_components
from .textbytes import shingle_sets, slices

WIDTH = 5
BLOCK = 64
#: Blocks that a group has in the search of the rest, and shingles of such a block, which makes them more.
TILES, TILE_TOKENS = 16, 1 << 19
#: Bits of the survivors' filter.
BLOOM_BITS = 26
FLUSH = 1_000_000
#: Bytes of input that a range of postings comes from, at most.
RANGE_BYTES = 16 << 20
POSTINGS = "bucket int, a binary, b binary"
U64 = np.uint64


def least_overlap(n):
    """Shingles that a set of ``n`` must share with any partner."""
    return (3 * n + 3) // 4


def extra(n):
    """``l``: by how many shingles the prefix is longer than the shortest sufficient one, and one more."""
    return n // 5 + 1


def sure(n):
    """Shingles of the prefix that any partner is sure to have in its own.

    The overlap is at least ``least_overlap`` of the larger set, and each prefix leaves
    out ``least_overlap - extra`` shingles, which grows with the size but for steps of 1.
    """
    return extra(n) - 1


def linked(overlap: int, n: int, m: int) -> bool:
    return 100 * overlap >= 75 * (n + m - overlap)


def _node(tokens: np.ndarray) -> int:
    """Name of a set: 64 bits of a hash, so two of ten billion sets share one with a chance of some 3 in 1000."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return (((keys >> U64(40)) * U64(n)) >> U64(24)).astype(np.int32)


def _scatter(keys: np.ndarray, values: np.ndarray, n: int, behind: int = 0) -> pa.RecordBatch:
    """Pairs packed by range of the key; ranges are numbered from ``behind``."""
    b = _bucket(keys, n) + np.int32(behind)
    order = np.argsort(b, kind="stable")
    b, keys, values = b[order], keys[order], values[order]
    first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
    ends = np.r_[first[1:], len(b)]
    cut = lambda x: pa.array([x[s:e].tobytes() for s, e in zip(first, ends)], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(b[first], pa.int32()), cut(keys), cut(values)], names=["bucket", "a", "b"])


def _flat(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


#: Marks that stand for "several sets of one task"; no set has them.
SEVERAL = (0, 1)
COUNT = np.dtype([("n", "<i4"), ("c", "<i4")])


def _prefix_postings(buckets: int, fewer: int):
    """Texts to postings (shingle, mark) of their prefixes, and to counts of marks (in ``fewer`` ranges behind those).

    A set is posted once in a task. Of a shingle that several sets of the task have, the
    task counts it for each and posts that there are several.
    """

    def flush(keys: list[np.ndarray], marks: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, owner = np.concatenate(keys), np.repeat(np.arange(len(keys)), list(map(len, keys)))
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n = np.diff(np.r_[starts, len(key)])
        single = np.repeat(n == 1, n)
        shared = key[starts[n > 1]]
        yield _scatter(np.concatenate([key[single], shared, shared]), np.concatenate([marks[owner[single]], np.full(len(shared), SEVERAL[0], U64), np.full(len(shared), SEVERAL[1], U64)]), buckets)
        counts = np.empty(len(marks), COUNT)
        counts["n"], counts["c"] = sizes, np.bincount(owner[~single], minlength=len(marks))
        yield _scatter(marks, counts, fewer, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, marks, sizes, held = [], [], [], 0
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                for tokens in shingle_sets(data, offsets, WIDTH):
                    n = len(tokens)
                    if not n or (mark := max(len(SEVERAL), _node(tokens) & 0xFFFFFFFFFFFFFFFF)) in seen:
                        continue
                    seen.add(mark)
                    p = n - least_overlap(n) + extra(n)
                    keys.append(tokens[:p])
                    marks.append(mark)
                    sizes.append(n)
                    held += p
                if held > max(FLUSH, 64 * buckets):
                    yield from flush(keys, np.array(marks, U64), np.array(sizes, np.int32))
                    keys, marks, sizes, held = [], [], [], 0
        if keys:
            yield from flush(keys, np.array(marks, U64), np.array(sizes, np.int32))

    return run


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order of key and value; starts and lengths of the runs of a key."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    if len(keys):
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (values[1:] != values[:-1])]
        keys, values = keys[fresh], values[fresh]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys, values, starts, np.diff(np.r_[starts, len(keys)])


def _shared_counts(buckets: int, fewer: int):
    """Postings of a range to counts of marks, in ``fewer`` ranges: how many of the range's shingles others have too. Counts pass through."""

    def run(table: pa.Table) -> pa.Table:
        if (first := table.column("bucket")[0].as_py()) >= buckets:
            return table.set_column(0, "bucket", pa.array(np.full(len(table), first - buckets, np.int32)))
        _, marks, _, n = _runs(_flat(table.column("a"), U64), _flat(table.column("b"), U64))
        found, count = np.unique(marks[np.repeat(n > 1, n)], return_counts=True)
        found, count = found[np.searchsorted(found, len(SEVERAL)) :], count[np.searchsorted(found, len(SEVERAL)) :]
        out = np.zeros(len(found), COUNT)
        out["c"] = count
        return pa.Table.from_batches([_scatter(found, out, fewer)])

    return run


def _survivor_bits(table: pa.Table) -> pa.Table:
    """Counts of a range of marks to the filter's words: which bits of which word are set.

    A set of several tasks has its size and a count of its own from each; the greatest is
    taken, and what the ranges found is added, so no set is counted short.
    """
    marks, counts = _flat(table.column("a"), U64), _flat(table.column("b"), COUNT)
    found, at = np.unique(marks, return_inverse=True)
    size, own = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    told = counts["n"] > 0
    np.maximum.at(size, at[told], counts["n"][told])
    np.maximum.at(own, at[told], counts["c"][told])
    total = own + np.bincount(at[~told], counts["c"][~told], len(found)).astype(np.int64)
    bits = (found[total >= np.maximum(1, sure(size))] >> U64(64 - BLOOM_BITS)).astype(np.int64)
    words, at = np.unique(bits >> 6, return_inverse=True)
    value = np.zeros(len(words), U64)
    np.bitwise_or.at(value, at, U64(1) << (bits & 63).astype(U64))
    return pa.table({"a": pa.array([words.astype(np.int32).tobytes()], pa.binary()), "b": pa.array([value.tobytes()], pa.binary())})


def _nodes(bloom):
    """Texts to (doc_id, n_shingles, node), with the shingles where the filter has the node, once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = bloom.value, set()
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                ns, nodes, sets = [], [], []
                for tokens in shingle_sets(data, offsets, WIDTH):
                    node = _node(tokens)
                    at = (node & 0xFFFFFFFFFFFFFFFF) >> (64 - BLOOM_BITS)
                    send = len(tokens) and (int(bits[at >> 6]) >> (at & 63)) & 1 and node not in seen
                    if send:
                        seen.add(node)
                    ns.append(len(tokens))
                    nodes.append(node)
                    sets.append(tokens.tobytes() if send else None)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(ns, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["doc_id", "n_shingles", "node", "tokens"])

    return run


OWNER = np.dtype([("node", "<i8"), ("n", "<i4")])
COUNTED = np.dtype([("token", "<u8"), ("df", "<i4"), ("n", "<i4")])


def _all_postings(buckets: int):
    """Nodes to postings (shingle, node and size) of all their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x, U64) for x in batch.column(1).to_pylist()]
            n = np.array([len(x) for x in sets], np.int32)
            owner = np.empty(int(n.sum()), OWNER)
            owner["node"], owner["n"] = np.repeat(batch.column(0).to_numpy(), n), np.repeat(n, n)
            yield _scatter(np.concatenate([np.zeros(0, U64), *sets]), owner, buckets)

    return run


def _document_counts(buckets: int):
    """Postings of a range to (node; shingle, nodes that have it, size) for the shingles of two nodes or more."""

    def run(table: pa.Table) -> pa.Table:
        keys, owner = _flat(table.column("a"), U64), _flat(table.column("b"), OWNER)
        order = np.lexsort((owner["node"], keys))
        keys, owner = keys[order], owner[order]
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (owner["node"][1:] != owner["node"][:-1])]
        keys, owner = keys[fresh], owner[fresh]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        df = np.diff(np.r_[starts, len(keys)])
        df = np.repeat(df, df)
        out = np.empty(int(np.count_nonzero(df > 1)), COUNTED)
        out["token"], out["df"], out["n"] = keys[df > 1], df[df > 1], owner["n"][df > 1]
        return pa.Table.from_batches([_scatter(owner["node"][df > 1].view(U64), out, buckets)])

    return run


def _shared_sets(table: pa.Table) -> pa.Table:
    """Counted shingles of a range of nodes to (node, n, tokens, prefix, weight), if a node has enough of them.

    ``weight``: how many nodes have a shingle of it, on average over all its shingles.
    """
    nodes, counted = _flat(table.column("a"), np.int64), _flat(table.column("b"), COUNTED)
    order = np.lexsort((counted["token"], nodes))
    nodes, counted = nodes[order], counted[order]
    starts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]]) if len(nodes) else np.zeros(0, np.int64)
    name, size, tokens, prefix, weight = [], [], [], [], []
    for s, e in zip(starts, np.r_[starts[1:], len(nodes)]):
        n = int(counted["n"][s])
        spare = e - s - least_overlap(n)
        if spare >= 0:
            own = counted["token"][s:e]
            name.append(int(nodes[s]))
            size.append(n)
            tokens.append(own.tobytes())
            prefix.append(own[np.lexsort((own, counted["df"][s:e]))[: spare + 1]].tobytes())
            weight.append(float(counted["df"][s:e].sum()) / n)
    return pa.table({"node": pa.array(name, pa.int64()), "n": pa.array(size, pa.int32()), "tokens": pa.array(tokens, pa.binary()), "prefix": pa.array(prefix, pa.binary()), "weight": pa.array(weight, pa.float64())})


def _rare_postings(buckets: int):
    """Nodes to postings (shingle, node) of their prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x, U64) for x in batch.column(1).to_pylist()]
            nodes = np.repeat(batch.column(0).to_numpy(), [len(x) for x in sets])
            yield _scatter(np.concatenate([np.zeros(0, U64), *sets]), nodes.view(U64), buckets)

    return run


def _forest(table: pa.Table) -> pa.Table:
    """Nodes that share a shingle of the range, as links to the smallest of their part."""
    _, nodes, starts, n = _runs(_flat(table.column("a"), U64), _flat(table.column("b"), np.int64))
    several = np.repeat(n > 1, n)
    name, b = np.unique(nodes[several], return_inverse=True)
    a = np.repeat(np.arange(len(n)), n)[several]
    runs = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    a = np.repeat(b[runs], np.diff(np.r_[runs, len(b)]))
    label = np.arange(len(name))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b):
            np.minimum.at(new, label[side], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(name))
    return pa.table({"u": name[away], "v": name[label[away]]}, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))


def search(sets: list[np.ndarray], sizes: list[int], parts: list[int]) -> list[tuple[int, int]]:
    """Links that connect ``sets`` as all their links would.

    ``sets``: the shingles that may be shared; ``sizes``: of the whole sets; ``parts``:
    known parts, whose members need no link. T-occurrence search over the sets in order
    of size, the largest part first as nothing in it needs a search; see the module's text.
    """
    most = max(Counter(parts).items(), key=lambda x: x[1])[0]
    order = sorted(range(len(sets)), key=lambda i: (parts[i] != most, sizes[i]))
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out, groups = [], len(sets)

    def join(i: int, j: int) -> None:
        nonlocal groups
        if (a := root(i)) != (b := root(j)):
            parent[a] = b
            groups -= 1

    first: dict[int, int] = {}
    for i, p in enumerate(parts):
        join(i, first.setdefault(p, i))

    tokens, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1  # of the shingles that two sets have
    own, masks, s = [], [], 0
    for x in sets:
        mine = at[s : s + len(x)]
        mine, s = number[mine[count[mine] > 1]], s + len(x)
        bits = np.zeros(int(number[-1]) + 1 if len(number) else 0, bool)
        bits[mine] = True
        own.append(mine.tolist())
        masks.append(int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little"))

    def meets(i: int, j: int, overlap: int) -> bool:
        if linked(overlap, sizes[i], sizes[j]):
            out.append((i, j))
            join(i, j)
            return True
        return False

    lists: dict[int, list[int]] = {}  # inverted lists of positions in ``order``
    heads: dict[int, int] = {}  # a member of each part seen so far
    for place, x in enumerate(order):
        if groups == 1:
            break
        n = sizes[x]
        heads = {root(i): i for i in heads.values()}
        alone = next(iter(heads.values())) if len(heads) == 1 else -1
        if not (alone >= 0 and (root(x) in heads or meets(x, alone, (masks[x] & masks[alone]).bit_count()))):
            need = -(-3 * (n + least_overlap(n)) // 7)
            of = sorted((t for t in own[x] if t in lists), key=lambda t: len(lists[t]))
            if len(of) >= need:
                short = of[: len(of) - need + 1]  # need - 1 long lists are set aside
                aside = masks[x]
                for t in short:
                    aside ^= 1 << t
                for y, same in groupby(heapq.merge(*(lists[t] for t in short))):
                    z = order[y]
                    if root(z) != root(x) and 4 * sizes[z] >= 3 * n:
                        meets(x, z, sum(1 for _ in same) + (masks[z] & aside).bit_count())
        heads[root(x)] = x
        for t in own[x]:
            lists.setdefault(t, []).append(place)
    return out


def _stars(ids: list[int], pivot: list[bool], links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links as each linked node and the first of its part: its smallest pivot, else its smallest node."""
    label = list(range(len(ids)))

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = i = label[label[i]]
        return i

    for i, j in links:
        a, b = sorted((root(i), root(j)), key=lambda k: (not pivot[k], ids[k]))
        label[b] = a
    return [(ids[i], ids[root(i)]) for i in range(len(ids)) if root(i) != i]


def _search_blocks(table: pa.Table) -> pa.Table:
    """Blocks (comp, block) of nodes to links that connect them."""
    keys = np.stack([table.column(c).to_numpy() for c in ("comp", "block", "chunk")])
    order = np.lexsort(keys[::-1])
    nodes, parts, sizes, blobs = table.column("node").to_numpy(), table.column("part").to_numpy(), table.column("n").to_numpy(), table.column("tokens")
    pivots = table.column("pivot").to_numpy(zero_copy_only=False)
    keys = keys[:, order]
    ends = np.flatnonzero(np.r_[(keys[:, 1:] != keys[:, :-1]).any(axis=0), True]) + 1
    u, v, s = [], [], 0
    for e in ends:
        mine = {}
        for k in sorted(order[s:e], key=lambda k: not pivots[k]):
            mine.setdefault(int(nodes[k]), k)
        s = e
        if len(mine) > 1:
            ids = list(mine)
            sets = [np.frombuffer(blobs[int(k)].as_py(), U64) for k in mine.values()]
            links = search(sets, [int(sizes[k]) for k in mine.values()], [int(parts[k]) for k in mine.values()])
            for i, j in _stars(ids, [bool(pivots[k]) for k in mine.values()], links):
                u.append(i)
                v.append(j)
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _blocks(rows: DataFrame) -> DataFrame:
    """Links found in the blocks of ``rows`` (comp, block, chunk, node, part, pivot, n, tokens); blocks are searched many at a time."""
    rows = rows.select("comp", "block", "chunk", "node", "part", "pivot", "n", "tokens", F.pmod(F.xxhash64("comp", "block", "chunk"), F.lit(16 * partitions(rows.sparkSession))).alias("deal"))
    return rows.groupBy("deal").applyInArrow(lambda t: _search_blocks(t), "u long, v long")


def _prefix_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, prefix) to a row per shingle of the prefix."""
    for b in batches:
        sets = [np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), [len(x) for x in sets])), pa.array(np.concatenate([np.zeros(0, np.int64), *sets]))], names=["node", "token"])


def _links(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """Links between ``nodes`` (node, n, tokens, prefix, weight) that connect what all links would; ``groups``: (node, label)."""
    salt = lambda k: 0.5 + F.pmod(F.xxhash64("node", F.lit(k)), F.lit(1024)) / 2048
    heavy = lambda by: F.max(F.struct(by.alias("by"), "node"))["node"]
    pivots = F.array_distinct(F.array(heavy(F.col("weight")), *(heavy(F.col("weight") * salt(k)) for k in range(2)), heavy(salt(2))))
    size = groups.join(nodes.select("node", "n", "weight"), "node").groupBy("label").agg(F.count("*").alias("m"), F.avg("n").alias("tokens"), pivots.alias("pivots"))
    width = F.greatest(F.lit(BLOCK), F.least(F.ceil(F.col("m") / TILES), F.ceil(TILE_TOKENS / F.col("tokens")))).cast("int")
    size = materialise(size.withColumns({"blocks": F.ceil(F.col("m") / BLOCK).cast("int"), "wide": width}), "join-sizes")
    member = materialise(groups.join(size.select("label", "blocks"), "label"), "join-members")
    member = member.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pivot = size.where("blocks > 1").select("label", F.explode("pivots").alias("node"), F.sequence(F.lit(0), F.col("blocks") - 1).alias("block"))
    row = lambda t, p: t.select(F.col("label").alias("comp"), "block", F.lit(0).alias("chunk"), "node", F.col("node").alias("part"), F.lit(p).alias("pivot"), "n", "tokens")
    apart = row(nodes.join(member, "node"), False).unionByName(row(nodes.join(pivot, "node").withColumn("block", F.explode("block")), True))
    found = materialise(_blocks(apart), "join-links")
    large = member.where("blocks > 1")
    if large.isEmpty():
        return found
    part = found.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("part"))  # parts that blocks agree on: a pivot, if any
    large = materialise(large.join(part, "node", "left").withColumn("part", F.coalesce("part", "node")), "join-large")
    counted = large.groupBy("label", "part").agg(F.count("*").alias("c"))
    main = counted.groupBy("label").agg(F.max_by("part", F.struct("c", "part")).alias("main"), (F.sum("c") - F.max("c")).alias("outside")).where("outside > 0")
    main = main.join(size.select("label", "m", "wide"), "label")
    main = materialise(main.withColumns({"chunks": F.ceil(F.col("outside") / F.col("wide")).cast("int"), "tiles": F.ceil(F.col("m") / F.col("wide")).cast("int")}).drop("m"), "join-rest")
    if main.isEmpty():
        return found
    left = large.join(main, "label").join(counted, ["label", "part"])
    # a part's documents are alike, so they share a chunk; a large part is dealt over several
    some = F.pmod(F.xxhash64("part"), F.col("chunks")) * F.lit(1 << 20) + F.pmod(F.xxhash64("node", F.lit(7)), F.ceil(F.col("c") / F.col("wide")))
    left = materialise(left.select("label", "node", "part", F.pmod("block", "tiles").alias("block"), F.when(F.col("part") != F.col("main"), some).alias("chunk")), "join-left")
    token = nodes.select("node", "prefix").join(left, "node", "left_semi").mapInArrow(_prefix_tokens, "node long, token long")
    posted = materialise(token.join(left, "node"), "join-posted")
    asked = materialise(posted.where("chunk IS NOT NULL").select("label", "token", F.col("chunk").alias("asks")).distinct(), "join-asked")
    lists = posted.groupBy("label", "token").agg(F.count("*").alias("list"))
    cost = asked.join(lists, ["label", "token"]).groupBy("label", "asks").agg(F.sum("list").alias("cost"))
    cost = materialise(cost.join(size.select("label", "m"), "label").select("label", "asks", (F.col("cost") >= F.col("m")).alias("whole")), "join-cost")
    narrow = asked.join(cost.where("NOT whole"), ["label", "asks"])
    near = posted.join(narrow, ["label", "token"]).select("label", "asks", "block", "node", "part").distinct()
    wide = cost.where("whole").groupBy("label").agg(F.collect_list("asks").alias("all"))  # a chunk for every ``wide`` of the group, at most
    met = materialise(near.unionByName(left.join(wide, "label").select("label", F.explode("all").alias("asks"), "block", "node", "part")), "join-met")
    ask = left.where("chunk IS NOT NULL").select("label", F.col("chunk").alias("asks"), "node", "part")
    asking = ask.join(met.select("label", "asks", "block").distinct(), ["label", "asks"])
    pairs = met.unionByName(asking.select(*met.columns)).distinct()
    more = nodes.join(pairs, "node").select(F.col("label").alias("comp"), "block", F.col("asks").alias("chunk"), "node", "part", F.lit(False).alias("pivot"), "n", "tokens")
    return found.unionByName(materialise(_blocks(more), "join-links"))


def similar_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id."""
    spark, since = docs.sparkSession, written()
    sc, few = spark.sparkContext, max(8, partitions(spark) // 4)
    buckets = max(2 * partitions(spark), tasks_for(docs, RANGE_BYTES))
    fewer = max(8, buckets // 8)  # counts are few beside postings, and every range writes to every range
    dealt = lambda t, n=buckets: t.repartition(max(partitions(spark), n // 2), "bucket").groupBy("bucket")
    posted = bounded_batches(docs).select("text").mapInArrow(freeing(_prefix_postings(buckets, fewer)), POSTINGS)
    counts = materialise(dealt(posted).applyInArrow(_shared_counts(buckets, fewer), POSTINGS), "join-counts")
    bloom = np.zeros(1 << (BLOOM_BITS - 6), U64)
    for r in dealt(counts, fewer).applyInArrow(lambda t: _survivor_bits(t), "a binary, b binary").toLocalIterator():
        np.bitwise_or.at(bloom, np.frombuffer(r["a"], np.int32), np.frombuffer(r["b"], U64))
    discard(counts)
    rows = materialise(docs.select("doc_id", "text").mapInArrow(freeing(_nodes(sc.broadcast(bloom))), "doc_id long, n_shingles long, node long, tokens binary"), "join-nodes")
    marked = rows.where("tokens IS NOT NULL").select("node", "tokens")
    counted = dealt(marked.mapInArrow(freeing(_all_postings(buckets)), POSTINGS)).applyInArrow(_document_counts(buckets // 2), POSTINGS)
    shared = dealt(counted, buckets // 2).applyInArrow(lambda t: _shared_sets(t), "node long, n int, tokens binary, prefix binary, weight double")
    nodes = materialise(shared, "join-sets")
    near = nodes.select("node", "prefix").mapInArrow(freeing(_rare_postings(few)), POSTINGS).groupBy("bucket").applyInArrow(lambda t: _forest(t), "u long, v long")
    labels = materialise(connected_components(_links(nodes, connected_components(near))), "join-labels")
    least = materialise(rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("d")), "join-least")
    of_label = least.join(labels, "node").groupBy("label").agg(F.min("d").alias("c"))
    of_node = materialise(least.join(labels.join(of_label, "label").select("node", "c"), "node", "left").select("node", F.coalesce("c", "d").alias("component_id")), "join-components")
    discard_since(since, rows, of_node)
    some = rows.where("n_shingles > 0").join(of_node, "node").select("doc_id", "n_shingles", "component_id")
    return some.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component those with its id.

    The ids that go are the fewer, so they are joined away. An id that stays in one
    component stays in all; rows without an id stay.
    """
    stays, since = F.max(F.col("doc_id") == F.col("component_id")), written()
    gone = materialise(similar_groups(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(stays.alias("stays")).where("NOT stays").select("doc_id"), "join-gone")
    discard_since(since, gone)
    return docs.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
