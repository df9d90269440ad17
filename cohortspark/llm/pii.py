"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass: at-signs, plus signs, digits,
schemes and identifier cues. Local parsers expand an anchor to its boundaries and
validate what they find:

- base kinds (email, ip, card, phone), exactly the contract's patterns: leftmost matches
  that don't overlap, per kind, then dropped if invalid;
- ``url``: an address that names a person or account (mail scheme, user before the host,
  or a query that holds an email);
- ``account``: after a cue (IBAN, account, passport, ...), a code of ``CODE_LEAST`` to
  ``CODE_MOST`` characters, at least half of them digits; an IBAN must pass its checksum.

A parser looks at the characters up to the next anchor of its kind or at a bounded
number of them, so a text's time is in proportion to its length. Null and empty texts
have no span. Repeated rows and ids are scanned each, null ids stay null, whole texts of
any length; an empty table gives an empty table; further columns are ignored. Offsets
count code points, ends exclusive; of spans with one start the kind listed first comes
first.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "url", "account")
ORDER = {k: i for i, k in enumerate(ALL_KINDS)}
CODE_LEAST, CODE_MOST, CODE_GAP = 6, 34, 3
URL_MOST, SCHEME_MOST = 2048, 32
#: Cues and schemes.
CUES = ("iban", "account", "acct", "passport", "konto", "kontonummer", "compte", "cuenta", "ssn", "social security", "tax id", "national id")
SCHEMES = ("mailto:", "://")
OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s\"'<>()\[\]{}|]{1,%d}" % URL_MOST)
_LEAD = re.compile(r"(?:\s{0,%d}(?:no|number|nr|n°|num)\b\.?)?[\s:#=.-]{0,%d}" % (CODE_GAP, CODE_GAP), re.I)
_CODE = re.compile(r"[A-Za-z0-9]{1,%d}+(?:[ -][0-9]{1,%d}+){0,%d}(?![A-Za-z0-9])" % (CODE_MOST, CODE_MOST, CODE_MOST))
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}")


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("d", 1))
    found.add_word("@", ("@", 1))
    found.add_word("+", ("+", 1))
    for s in SCHEMES:
        found.add_word(s, ("s", len(s)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            found.add_word(form, ("c", len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _iban(code: str) -> bool:
    code = re.sub(r"[ -]", "", code).upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", code):
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


class _Base:
    """Leftmost matches of each base kind, offered anchor by anchor from left to right."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.end = dict.fromkeys(KINDS, 0)
        self.spans: list[tuple[int, int, str]] = []

    def _take(self, kind: str, start: int, end: int, valid: bool) -> None:
        self.end[kind] = end
        if valid:
            self.spans.append((start, end, kind))

    def at_sign(self, p: int) -> None:
        if p < (low := self.end["email"]):
            return
        s = p
        while s > low and self.text[s - 1] in _LOCAL:
            s -= 1
        if s < p and (m := _DOMAIN.match(self.text, p + 1)):
            self._take("email", s, m.end(), True)

    def digits(self, p: int) -> None:
        """``p``: where a run of digits starts."""
        if p >= self.end["ip"] and (m := _IP.match(self.text, p)):
            self._take("ip", p, m.end(), all(map(_byte, m[0].split("."))))
        if p >= self.end["card"] and (m := _CARD.match(self.text, p)):
            d = _digits(m[0])
            self._take("card", p, m.end(), 14 <= len(d) <= 19 and luhn(d))

    def plus(self, p: int) -> None:
        if p >= self.end["phone"] and (m := _PHONE.match(self.text, p)):
            self._take("phone", p, m.end(), 10 <= len(_digits(m[0])) <= 15)


def _url(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The address around a scheme anchor, if it names a person."""
    s = start
    if text[start:end] == "://":
        while s > max(0, start - SCHEME_MOST) and (text[s - 1].isalnum() or text[s - 1] in "+.-"):
            s -= 1
        if s == start:
            return None
    m = _URL.match(text, end)
    if not m:
        return None
    rest = m[0].rstrip(".,;:!?")
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    if "@" in host and host.rpartition("@")[0] and (text[start:end] == "://" or _DOMAIN.match(host.rpartition("@")[2])):
        return s, end + len(rest)
    if text[start:end] == "://" and re.search(r"[?&#/=][A-Za-z0-9._%+-]+(@|%40)[A-Za-z0-9-]+\.", rest):
        return s, end + len(rest)
    return None


def _account(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The code behind a cue that stands as a word."""
    if start and text[start - 1].isalnum() or end < len(text) and text[end].isalpha():
        return None
    at = _LEAD.match(text, end).end()
    if text[start:end].lower() == "iban":
        code = _IBAN.match(text, at)
        code = code[0] if code else ""
        while code and not _iban(code):
            code = code.rpartition(" ")[0]
        return (at, at + len(code)) if code else None
    m = _CODE.match(text, at)
    plain = re.sub(r"[ -]", "", m[0]) if m else ""
    if not CODE_LEAST <= len(plain) <= CODE_MOST or 2 * len(_digits(plain)) < len(plain):
        return None
    return at, m.end()


def scan(text: str | None, anchors) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and added spans (start, end, kind) of one text."""
    if not text:
        return [], []
    base, more, last = _Base(text), [], -2
    taken = {"url": 0, "account": 0}
    for e, (kind, n) in anchors.iter(text):
        if kind == "d":
            if e != last + 1:
                base.digits(e)
            last = e
        elif kind == "@":
            base.at_sign(e)
        elif kind == "+":
            base.plus(e)
        else:
            name, parse = ("url", _url) if kind == "s" else ("account", _account)
            if e - n + 1 >= taken[name] and (span := parse(text, e - n + 1, e + 1)) and span[0] >= taken[name]:
                more.append((*span, name))
                taken[name] = span[1]
    key = lambda x: (x[0], ORDER[x[2]])
    return sorted(base.spans, key=key), sorted(more, key=key)


def shown(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for b in batches:
        counts, sha, spans = {k: [] for k in KINDS}, [], []
        for text in b.column(1):
            base, more = scan(text.as_py(), anchors)
            for k in KINDS:
                counts[k].append(sum(x[2] == k for x in base))
            sha.append(hashlib.sha256(shown(base).encode()).hexdigest())
            spans.append(shown(sorted(base + more, key=lambda x: (x[0], ORDER[x[2]]))))
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(sha), pa.array(spans)], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, counts of the base kinds, their digest, and all spans."""
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(_scanned, OUT)
