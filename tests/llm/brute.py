"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Rows (doc_id, text[, lang[, source]]) as a documents table."""
    full = [(*r, *("en", "s")[len(r) - 2 :], 0) if len(r) < 4 else (*r, 0) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def similar(rows):
    """(doc_id, size, component) per row (doc_id, text)."""
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        shared = Counter(j for x in s for j in index[x])
        for j, o in shared.items():
            if 100 * o >= 75 * (len(s) + len(sets[j][1]) - o):
                parent[max(root(i), root(j))] = min(root(i), root(j))
        for x in s:
            index[x].append(i)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(s), least.get(root(i))) for i, (d, s) in enumerate(sets)]


def personal(text):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1]))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], ("email", "ip", "card", "phone").index(x[2])))


def secret(text):
    out = [(m.start(), m.end(), "assign") for m in re.finditer(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[1]) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[0], ("assign", "access", "hex").index(x[2])))


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
