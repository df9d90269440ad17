"""Language identification by unigram pieces, all segmentations summed.

The vocabulary is a fixed public piece list. For each language a probability per piece
is learned by expectation maximisation from all words of a bounded sample of labelled
documents (of each language the ``SAMPLE_ROWS`` rows with the smallest hash of their id,
so a rare language teaches too). A word's probability is the sum over all ways to cut it
into pieces (forward algorithm), however long it is; a text's is the product over all its
words, and the score is the posterior under equal priors.

Text that is null or has no letter is ``und`` with score 0, as is every text if no row
has a language to learn from; of languages alike in probability the first in order wins.
Null ids stay null. Repeated rows are scored each, but an id teaches once, by the least
of its rows; very long texts and words are summed whole; an empty table gives an empty
table; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import bounded_batches, remainder, small
from .textbytes import SLICE, mixed, power_tables, slices

MODULUS, HELD_OUT = 4, 2
SAMPLE_ROWS = 300
ROUNDS = 2
SMOOTH = 0.05
#: Probability of a character that no piece holds.
UNKNOWN = 1e-9
#: Distinct words that are scored together.
CHUNK = 1 << 14
VOCABULARY = "piece_bpe_32k.model"
START = "▁"
#: Characters of a string up to which a sum of products is certain not to vanish; longer ones are scaled as they go.
SHORT = 32


def vocabulary(name: str = VOCABULARY) -> list[str]:
    """The pieces that are plain text."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=name if "/" in name else public_tokenizers.path(name))
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


def letters(word: str) -> str:
    return word.lower() if word.isalpha() else "".join(filter(str.isalpha, word)).lower()


def _edges(text: str, probability: dict[str, float], longest: int) -> list[tuple[int, int, float, str | None]]:
    """The pieces of ``text`` by start and end, a character that no piece holds as unknown."""
    out = []
    for i in range(len(text)):
        own = [(i, j, p, text[i:j]) for j in range(i + 1, min(len(text), i + longest) + 1) if (p := probability.get(text[i:j])) is not None]
        out += own if own and own[0][1] == i + 1 else [(i, i + 1, UNKNOWN, None), *own]
    return out


def _log_add(a: float, b: float) -> float:
    low, high = (a, b) if a < b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


def _expected(words: Counter, probability: dict[str, float], longest: int) -> dict[str, float]:
    """Expected piece counts of one language's words, by forward and backward sums."""
    out: dict[str, float] = {}
    for word, count in words.items():
        text = START + word
        m, edges = len(text), _edges(text, probability, longest)
        if m <= SHORT:
            f, b = [0.0] * (m + 1), [0.0] * (m + 1)
            f[0] = b[m] = 1.0
            for i, j, p, _ in edges:
                f[j] += f[i] * p
            for i, j, p, _ in reversed(edges):
                b[i] += b[j] * p
            share = lambda i, j, p: f[i] * p * b[j] / f[m]  # noqa: B023, E731
        else:  # the same with logarithms
            f, b = [-math.inf] * (m + 1), [-math.inf] * (m + 1)
            f[0] = b[m] = 0.0
            for i, j, p, _ in edges:
                f[j] = _log_add(f[j], f[i] + math.log(p))
            for i, j, p, _ in reversed(edges):
                b[i] = _log_add(b[i], b[j] + math.log(p))
            share = lambda i, j, p: math.exp(f[i] + math.log(p) + b[j] - f[m])  # noqa: B023, E731
        for i, j, p, piece in edges:
            if piece is not None:
                out[piece] = out.get(piece, 0.0) + count * share(i, j, p)
    return out


def learn(texts: list[tuple[str, str]], pieces: list[str]) -> tuple[list[str], dict[str, tuple[float, ...]]]:
    """Languages, and the probabilities of the pieces in each, from (language, text) rows."""
    by: dict[str, Counter] = {}
    for lang, text in texts:
        by.setdefault(lang, Counter()).update(w for x in text.split() if (w := letters(x)))
    langs, longest = sorted(by), max(map(len, pieces))
    columns = []
    for lang in langs:
        words = Counter(dict(sorted(by[lang].items())))  # in an order that reruns keep
        known = dict.fromkeys(pieces, 1.0)
        counts: dict[str, float] = {}
        for word, c in words.items():  # first guess: every occurrence of a piece
            for i, j, _, piece in _edges(START + word, known, longest):
                if piece is not None:
                    counts[piece] = counts.get(piece, 0.0) + c * (j - i) ** 2
        for step in range(ROUNDS + 1):
            total = sum(counts.values()) + SMOOTH * len(pieces)
            probability = {p: (counts.get(p, 0.0) + SMOOTH) / total for p in pieces}
            if step < ROUNDS:
                counts = _expected(words, probability, longest)
        columns.append(probability)
    return langs, {p: tuple(c[p] for c in columns) for p in pieces} if columns else {}


class Scorer:
    """Sums over all segmentations for many words at once, by hashes of their substrings."""

    def __init__(self, langs: list[str], table: dict[str, tuple[float, ...]]) -> None:
        self.langs = langs
        pieces = sorted(p for p in table if all(c == START or c.isalpha() for c in p))
        self.longest = max(map(len, pieces), default=0)
        self.p = np.array([table[x] for x in pieces] + [(UNKNOWN,) * len(langs)])
        keys = np.array([self._hash(x) for x in pieces], np.uint64)
        self.slots, rest = [], np.arange(len(keys))
        while len(rest):  # each table holds the first key of every slot; the few others go on to the next
            bits = 64 - (20 if not self.slots else 14)
            slot = (keys[rest] >> np.uint64(bits)).astype(np.int64) if not self.slots else (mixed(keys[rest] + np.uint64(len(self.slots))) >> np.uint64(bits)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            key, at = np.zeros(1 << (64 - bits), np.uint64), np.full(1 << (64 - bits), -1, np.int32)
            key[slot[first]], at[slot[first]] = keys[rest[first]], rest[first]
            self.slots.append((bits, key, at))
            rest = np.delete(rest, first)

    @staticmethod
    def _hash(piece: str) -> int:
        codes = mixed(np.array(list(map(ord, piece)), np.uint64))
        up, _ = power_tables(len(codes) + 1)
        return int(mixed(np.array([np.sum(codes * up[: len(codes)], dtype=np.uint64)], np.uint64))[0])

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Index of the piece with each hash, or -1."""
        out = np.full(len(h), -1, np.int32)
        for k, (bits, key, at) in enumerate(self.slots):
            if k == 0:
                slot = (h >> np.uint64(bits)).astype(np.int64)
                out = np.where(key[slot] == h, at[slot], out)
            else:
                open_ = np.flatnonzero(out < 0)
                slot = (mixed(h[open_] + np.uint64(k)) >> np.uint64(bits)).astype(np.int64)
                out[open_] = np.where(key[slot] == h[open_], at[slot], -1)
        return out

    def sums(self, run: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log of the summed probability per string and language; strings by start and size in the running hash."""
        out = np.zeros((len(starts), len(self.langs)))
        short = np.flatnonzero(sizes <= SHORT)
        order = short[np.argsort(-sizes[short], kind="stable")]
        for c in range(0, len(order), CHUNK):
            own = order[c : c + CHUNK]
            out[own] = self._together(run, starts[own], sizes[own])
        for k in np.flatnonzero(sizes > SHORT):
            out[k] = self._alone(run, int(starts[k]), int(sizes[k]))
        return out

    def _together(self, run: np.ndarray, s: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Short strings, the longest first, a character of all of them at a time."""
        _, down = power_tables(len(run))
        alpha = np.zeros((int(n[0]) + 1, len(s), len(self.langs)))
        alpha[0] = 1
        for t in range(1, int(n[0]) + 1):
            live = int(np.count_nonzero(n >= t))
            e = s[:live] + t
            for size in range(1, min(t, self.longest) + 1):
                piece = self._find(mixed((run[e] - run[e - size]) * down[e - size]))
                if size == 1:
                    alpha[t, :live] = alpha[t - 1, :live] * self.p[piece]  # -1: the unknown character, last
                else:
                    hit = np.flatnonzero(piece >= 0)
                    alpha[t, hit] += alpha[t - size, hit] * self.p[piece[hit]]
        return np.log(alpha[n, np.arange(len(s))])

    def _alone(self, run: np.ndarray, start: int, n: int) -> np.ndarray:
        """A string of any length: only the last sums are kept, scaled as they shrink."""
        _, down = power_tables(len(run))
        longest = max(1, self.longest)
        none = np.vstack([self.p, np.zeros((1, len(self.langs)))])  # the last row: no piece
        last, log = np.zeros((longest, len(self.langs))), np.zeros(len(self.langs))
        last[0] = 1.0  # sums of the last ``longest`` ends, the latest first
        for low in range(0, n, SLICE):
            e = start + np.arange(low + 1, min(n, low + SLICE) + 1)
            ids = np.full((len(e), longest), len(none) - 1)
            for size in range(1, longest + 1):
                ok = e - size >= start
                piece = self._find(mixed((run[e[ok]] - run[e[ok] - size]) * down[e[ok] - size]))
                ids[ok, size - 1] = np.where(piece >= 0, piece, len(self.p) - 1 if size == 1 else len(none) - 1)
            for k in range(len(e)):
                new = (last * none[ids[k]]).sum(axis=0)
                last[1:] = last[:-1]
                last[0] = new
                if k % 8 == 7:
                    last /= new
                    log += np.log(new)
        return log + np.log(last[0])

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood per text and language, and which texts have a letter."""
        low = [(t or "").lower() for t in texts]
        ends = np.cumsum([len(t) + 1 for t in low])
        cp = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le"), np.uint32)
        is_letter, is_space = _kinds(cp)
        where = np.flatnonzero(is_letter)
        total, some = np.zeros((len(low), len(self.langs))), np.zeros(len(low), bool)
        if not len(where):
            return total, some
        word = np.cumsum(is_space)[where]
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        chars = np.insert(cp[where].astype(np.uint64), first, ord(START))
        size = np.diff(np.r_[first, len(where)]) + 1
        start = np.cumsum(size) - size
        row = np.searchsorted(ends, where[first], side="right")
        up, down = power_tables(len(chars) + 1)
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(chars) * up[: len(chars)])])
        _, one, back = np.unique(mixed((run[start + size] - run[start]) * down[start]) + size.astype(np.uint64), return_index=True, return_inverse=True)
        logs = self.sums(run, start[one], size[one])
        for k in range(len(self.langs)):
            total[:, k] = np.bincount(row, logs[back, k], len(low))
        some[row] = True
        return total, some


_tables: list[np.ndarray] = []


def _kinds(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters, and which are white space."""
    if not _tables:
        basic = [chr(i) for i in range(0x10000)]
        _tables[:] = [np.array([c.isalpha() for c in basic]), np.array([c.isspace() for c in basic])]
    low = np.minimum(cp, 0xFFFF)
    letter, space = _tables[0][low], _tables[1][low]
    for i in np.flatnonzero(cp > 0xFFFF):
        letter[i] = chr(cp[i]).isalpha()
    return letter, space


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        langs = pa.array([*scorer.langs, "und"], pa.string())
        for b in batches:
            for i, j, *_ in slices(b.column(2), 2 * SLICE):
                own = b.slice(i, j - i)
                total, some = scorer.texts(own.column(2).to_pylist())
                if not scorer.langs:
                    some[:] = False
                best = np.where(some, total.argmax(axis=1) if scorer.langs else 0, len(scorer.langs))
                with np.errstate(over="ignore"):
                    score = np.where(some, 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1), 0.0) if scorer.langs else np.zeros(len(own))
                yield pa.RecordBatch.from_arrays([own.column(0).cast(pa.int64()), own.column(1), langs.take(pa.array(best)), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score."""
    held = (remainder(F.col("doc_id"), MODULUS) == HELD_OUT).alias("held_out")
    labelled = docs.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text", F.xxhash64("doc_id").alias("h"))
    # of each language about the share that is asked for, so no task orders a language; then exactly the smallest
    asked = labelled.groupBy("lang").agg((F.lit(2.0 * SAMPLE_ROWS) / F.count("*")).alias("share"))
    few = labelled.join(small(asked), "lang").where(F.shiftrightunsigned("h", 11) / float(1 << 53) <= F.col("share")).groupBy("lang", "h", "doc_id").agg(F.min("text").alias("text"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id"))
    sample = few.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_ROWS).orderBy("lang", "rank").collect()
    model = docs.sparkSession.sparkContext.broadcast(learn([(r["lang"], r["text"]) for r in sample], vocabulary(name)))
    return bounded_batches(docs).select("doc_id", held, "text").mapInArrow(_scored(model), "doc_id long, held_out boolean, lang_pred string, score double")
