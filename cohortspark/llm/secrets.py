"""Secret scan by a linear-chain conditional random field.

Lines are sequences of words. A word's features are its shape code (length class, kinds
of characters, cue words) at four places around it and a code of the whole file; each
code has a weight per tag (outside, begin, inside), so a batch is scored by table
look-ups. A line whose words all lie below the bound at which any other tag could pay is
certainly all outside; Viterbi decodes every other line.

The field is trained on the driver from the whole texts of a bounded sample of documents
(``SAMPLE_ROWS`` rows, those with the smallest hash of their id), every line of them:
half of the documents get made-up secrets put in, some behind a cue and some without,
tagged; words that the base patterns find are tagged as well. File codes are those of the
whole document, as in the scan. For the sums a line is dealt into chains of at most
``CHAIN`` words; all of them teach.

Base kinds (assign, access, hex) are exactly the contract's patterns and always stay;
decoded words that no base span touches are added as kind ``crf``, trimmed of quotes and
stops. Null and empty texts have no span; null ids stay null; repeated rows are scanned
each, and an id teaches once; very long texts are scanned whole; an empty table gives an
empty table; further columns are ignored. Offsets count code points; of spans with one
start the kind listed first comes first.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .textbytes import slices, word_bounds, word_hashes

KINDS = ("assign", "access", "hex")
ALL_KINDS = (*KINDS, "crf")
ORDER = {k: i for i, k in enumerate(ALL_KINDS)}
#: Documents that teach, at most; words of a chain; words of a document per made-up secret.
SAMPLE_ROWS, CHAIN, PER_SECRET = 300, 48, 60
ROUNDS, RATE, L2 = 100, 1.0, 1e-7
OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

_ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
#: Runs are maximal, so the least lengths can stand in the patterns.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Cue words, and what may stand around them.
CUES = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "key", "auth", "bearer", "credential", "credentials", "access_key", "secret_key", "private_key")
AROUND = [(a, b) for a in ("", '"', "'") for b in ("", '"', "'", ":", "=", '":', "':")]
CODES, FILE_CODES, PLACES = 6 * 2**8, 8, (-2, -1, 0, 1)
O, B, I = 0, 1, 2


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost matches that don't overlap, per kind; the failing ones dropped."""
    out = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], ORDER[x[2]]))


def _cue_hashes() -> np.ndarray:
    words = [(a + c + b).encode() for c in CUES for a, b in AROUND]
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
    return np.sort(word_hashes(data, starts, ends))


def _classes() -> list[np.ndarray]:
    every = np.arange(256)
    return [np.isin(every, list(x)) for x in (b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"=:", b"+/_.-", b"0123456789abcdefABCDEF", b"@")]


def shapes(data: np.ndarray, offsets: np.ndarray, cues: np.ndarray, classes: list[np.ndarray]):
    """Starts, ends, rows, lines and shape codes of the words of a batch, and a code per row."""
    starts, ends, row = word_bounds(data, offsets)
    n = ends - starts

    def inside(flags: np.ndarray) -> np.ndarray:
        run = np.concatenate([np.zeros(1, np.int32), np.cumsum(flags, dtype=np.int32)])
        return run[ends] - run[starts]

    digit, lower, upper, assign, joint, hexa, at_sign = (inside(c[data]) for c in classes)
    length = np.searchsorted([5, 8, 14, 20, 36], n, side="right")
    h = word_hashes(data, starts, ends)
    at = np.minimum(np.searchsorted(cues, h), len(cues) - 1)
    mixed = (digit > 0) & (lower + upper > 0)
    bits = [digit > 0, upper > 1, lower > 0, assign > 0, joint > 0, mixed & (4 * digit >= n) | (hexa == n) & mixed, cues[at] == h, at_sign > 0]
    code = length * 2 ** len(bits) + sum(b.astype(np.int64) << k for k, b in enumerate(bits))
    line = np.concatenate([np.zeros(1, np.int64), np.cumsum(data == 10)])[starts]
    new = np.r_[True, (line[1:] != line[:-1]) | (row[1:] != row[:-1])] if len(starts) else np.zeros(0, bool)
    rows = len(offsets) - 1
    count = np.maximum(np.bincount(row, minlength=rows), 1)
    share = lambda flag: np.bincount(row, flag, minlength=rows) / count
    file = (share(digit > 0) > 0.1).astype(np.int64) + 2 * (share(assign > 0) > 0.05) + 4 * (share(joint > 0) > 0.3)
    return starts, ends, row, np.cumsum(new) - 1, code, file


def _at(code: np.ndarray, line: np.ndarray, place: int) -> np.ndarray:
    """Codes ``place`` words on in the same line, CODES where there is none."""
    out = np.full(len(code), CODES)
    if place == 0:
        return code
    a, b = (slice(-place, None), slice(None, place)) if place < 0 else (slice(None, -place), slice(place, None))
    if len(code) > abs(place):
        out[a] = np.where(line[a] == line[b], code[b], CODES)
    return out


class Field:
    """Weights by place, code and tag; by file code and tag; and of the moves between tags. Outside is 0."""

    def __init__(self) -> None:
        self.w = np.zeros((len(PLACES), CODES + 1, 3))
        self.f = np.zeros((FILE_CODES, 3))
        self.t = np.zeros((3, 3))

    def emissions(self, codes: list[np.ndarray], file: np.ndarray) -> np.ndarray:
        return self.f[file] + sum(w[c] for w, c in zip(self.w, codes))

    def moves(self) -> np.ndarray:
        t = self.t.copy()
        t[O, I] = -1e9
        return t


_SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def made_up(rng: random.Random) -> str:
    """A secret: hexadecimal, an access key, or a token of letters and digits with or without a lead."""
    draw = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    kind = rng.randrange(5)
    if kind == 0:
        return draw("0123456789abcdef", rng.choice((32, 40, 64)))
    if kind == 1:
        return "AKIA" + draw("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)
    if kind == 2:
        return draw(LETTERS + "0123456789+/", rng.randrange(24, 48))
    if kind == 3:
        return draw(LETTERS + "0123456789", rng.randrange(20, 44))
    return rng.choice(("sk_", "ghp_", "xox-")) + draw(LETTERS + "0123456789", 30)


def planted(text: str, rng: random.Random, cue: float = 0.6, wrap: float = 0.15) -> tuple[str, list[tuple[int, int, int]]]:
    """A text with secrets put between its words, and their words (start, end, tag); ``cue``: the share behind one."""
    at = sorted(rng.sample(starts, min(len(starts), 1 + len(starts) // PER_SECRET))) if (starts := [m.start() for m in _SPACED.finditer(text)]) else []
    out, tags, low, n = [], [], 0, 0
    for p in [*at, len(text)]:
        out.append(text[low:p])
        n += p - low
        low = p
        if p == len(text):
            break
        secret, q = made_up(rng), rng.choice(("", '"'))
        lead = f"{rng.choice(CUES)} {rng.choice('=:')} " if rng.random() < cue else ""
        half = len(secret) // 2 if rng.random() < wrap else 0
        put = [(q + secret[:half], B), (secret[half:] + q, I)] if half else [(q + secret + q, B)]
        out.append(lead)
        n += len(lead)
        for word, tag in put:
            tags.append((n, n + len(word), tag))
            out.append(word + " ")
            n += len(word) + 1
    return "".join(out), tags


def _taught(texts: list[str], seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, every other one with secrets, as bytes and offsets, and the tag of each word."""
    rng = random.Random(seed)
    raw, tags = [], []
    for k, text in enumerate(texts):
        own: dict[int, int] = {}
        if k % 2:
            text, put = planted(text, rng)
            own = {s: tag for s, _, tag in put}
        found, j = base_spans(text), 0
        for m in _SPACED.finditer(text):
            tag = own.get(m.start(), O)
            while j < len(found) and found[j][1] <= m.start():
                j += 1
            if tag == O and m.end() - m.start() >= 16 and any(a < m.end() and m.start() < b and (kind != "assign" or b - m.start() >= m.end() - m.start()) for a, b, kind in found[j : j + 3]):
                tag = B
            tags.append(tag)
        raw.append(text.encode())
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum(list(map(len, raw)), dtype=np.int64)]), np.array(tags, np.int64)


def _chains(line: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Words dealt into chains: grids (chains by places) of word numbers, by width, and which places are filled."""
    starts = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    within = np.arange(len(line)) - np.repeat(starts, np.diff(np.r_[starts, len(line)]))
    first = np.flatnonzero(within % CHAIN == 0)
    size = np.diff(np.r_[first, len(line)])
    out, least = [], 0
    for width in (CHAIN // 4, CHAIN // 2, CHAIN):
        own = np.flatnonzero((size > least) & (size <= width))
        if len(own):
            at = first[own][:, None] + np.arange(width)
            mask = np.arange(width) < size[own][:, None]
            out.append((np.where(mask, at, 0), mask))
        least = width
    return out


def _sums(e: np.ndarray, mask: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of chains with emissions ``e``: each place's tag probabilities, and the expected moves, by scaled forward and backward sums."""
    n, width, _ = e.shape
    psi = np.exp(e - e.max(axis=2, keepdims=True))
    t = np.exp(moves)
    up, down = np.empty_like(psi), np.ones_like(psi)
    up[:, 0] = psi[:, 0] * np.array([1, 1, 0])
    up[:, 0] /= up[:, 0].sum(axis=1, keepdims=True)
    for k in range(1, width):
        new = (up[:, k - 1] @ t) * psi[:, k]
        up[:, k] = np.where(mask[:, k, None], new / new.sum(axis=1, keepdims=True), up[:, k - 1])
    pairs = np.zeros((3, 3))
    for k in range(width - 2, -1, -1):
        ahead = psi[:, k + 1] * down[:, k + 1]
        back = ahead @ t.T
        live = mask[:, k + 1, None]
        down[:, k] = np.where(live, back / back.sum(axis=1, keepdims=True), 1.0)
        z = (up[:, k] * back).sum(axis=1, keepdims=True)
        pairs += t * ((up[:, k] / z * live).T @ ahead)
    p = up * down
    return p / p.sum(axis=2, keepdims=True) * mask[:, :, None], pairs


def train(texts: list[str]) -> Field:
    """The field by gradient steps on the conditional likelihood."""
    field = Field()
    data, offsets, tags = _taught(texts)
    if not len(tags):
        return field
    _, _, row, line, code, file = shapes(data, offsets, _cue_hashes(), _classes())
    codes, files = [_at(code, line, p) for p in PLACES], file[row]
    grids = _chains(line)
    onehot = np.eye(3)[tags]
    gold = np.zeros((3, 3))
    for at, mask in grids:
        y = onehot[at] * mask[:, :, None]
        gold += np.einsum("ijk,ijl->kl", y[:, :-1], y[:, 1:])
    steps = [np.zeros_like(x) for x in (field.w, field.f, field.t)]
    for _ in range(ROUNDS):
        e, p, pairs = field.emissions(codes, files), np.zeros_like(onehot), np.zeros((3, 3))
        for at, mask in grids:
            own, more = _sums(e[at], mask, field.moves())
            p[at[mask]] = own[mask]
            pairs += more
        diff = onehot - p
        gw, gf, gt = np.zeros_like(field.w), np.zeros_like(field.f), gold - pairs
        for tag in (B, I):
            for k, c in enumerate(codes):
                gw[k, :, tag] = np.bincount(c, diff[:, tag], CODES + 1)
            gf[:, tag] = np.bincount(files, diff[:, tag], FILE_CODES)
        gt[O, O] = gt[O, I] = 0
        for x, g, s in zip((field.w, field.f, field.t), (gw, gf, gt), steps):
            g -= L2 * len(tags) * x
            s += g**2
            x += RATE * g / np.sqrt(s + 1e-6)
    return field


def viterbi(e: np.ndarray, t: np.ndarray) -> list[int]:
    """Best tags of one line."""
    best, back = [0.0 + e[0][O], e[0][B], -1e9], []
    for row in e[1:]:
        now, came = [], []
        for tag in (O, B, I):
            k = max((O, B, I), key=lambda x: best[x] + t[x][tag])
            now.append(best[k] + t[k][tag] + row[tag])
            came.append(k)
        best = now
        back.append(came)
    tags = [max((O, B, I), key=lambda x: best[x])]
    for came in reversed(back):
        tags.append(came[tags[-1]])
    return tags[::-1]


def decode(field: Field, data: np.ndarray, offsets: np.ndarray, cues: np.ndarray, classes: list[np.ndarray]) -> dict[int, list[tuple[int, int]]]:
    """Byte spans of decoded secrets, by row."""
    starts, ends, row, line, code, file = shapes(data, offsets, cues, classes)
    out: dict[int, list[tuple[int, int]]] = {}
    if not len(starts):
        return out
    codes = [_at(code, line, p) for p in PLACES]
    t = field.moves()
    real = t[t > -1e8]
    bound = max(0.0, t[:, 1:][t[:, 1:] > -1e8].max()) + max(0.0, t[1:, O].max()) if len(real) else 0.0
    top = sum(w[c, B] for w, c in zip(field.w, codes)) + field.f[file[row], B]
    inside = sum(w[c, I] for w, c in zip(field.w, codes)) + field.f[file[row], I]
    live = np.unique(line[np.maximum(top, inside) + bound > 0])
    first = np.searchsorted(line, live)
    moves = t.tolist()
    for s, k in zip(first, np.searchsorted(line, live, side="right")):
        e = np.stack([np.zeros(k - s), top[s:k], inside[s:k]], axis=1).tolist()
        tags = viterbi(e, moves)
        i = 0
        while i < len(tags):
            j = i + 1
            if tags[i] == B:
                while j < len(tags) and tags[j] == I:
                    j += 1
                out.setdefault(int(row[s]), []).append((int(starts[s + i]), int(ends[s + j - 1])))
            i = j
    return out


def _trimmed(text: str, s: int, e: int) -> tuple[int, int]:
    while s < e and not (text[s].isalnum() or text[s] in "+/_-"):
        s += 1
    while s < e and not (text[e - 1].isalnum() or text[e - 1] in "+/_-="):
        e -= 1
    return s, e


def _apart(found: list[tuple[int, int]], base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Of spans in order those of 6 characters or more that no base span touches."""
    out, reach, k = [], -1, 0  # ``reach``: the furthest end of the base spans that start before
    for s, e in found:
        while k < len(base) and base[k][0] < e:
            reach = max(reach, base[k][1])
            k += 1
        if e - s >= 6 and reach <= s:
            out.append((s, e))
    return out


def shown(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _scanned(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, cues, classes = model.value, _cue_hashes(), _classes()
        for b in batches:
            for i, j, data, offsets in slices(b.column(1)):
                decoded = decode(field, data, offsets, cues, classes)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if decoded else None  # characters before each byte
                counts, sha, spans = {k: [] for k in KINDS}, [], []
                for r, text in enumerate(b.column(1).slice(i, j - i).to_pylist()):
                    base = base_spans(text or "")
                    every = list(base) + [(s, e, "crf") for s, e in _apart([_trimmed(text, int(chars[s] - chars[offsets[r]]), int(chars[e] - chars[offsets[r]])) for s, e in decoded.get(r, ())], base)]
                    for k in KINDS:
                        counts[k].append(sum(x[2] == k for x in base))
                    sha.append(hashlib.sha256(shown(base).encode()).hexdigest())
                    spans.append(shown(sorted(every, key=lambda x: (x[0], ORDER[x[2]]))))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).cast(pa.int64()), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(sha), pa.array(spans)], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return run


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, counts of the base kinds, their digest, and all spans."""
    some = docs.where(F.col("text").isNotNull())
    chosen = some.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    one = some.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))  # an id teaches once
    model = docs.sparkSession.sparkContext.broadcast(train([r["text"] for r in one.orderBy("doc_id").collect()]))
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(_scanned(model), OUT)
