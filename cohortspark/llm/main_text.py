"""Main text of web pages by tree scoring.

A page is cut into tags and text by one pattern and built into a tree with the implied
ends of HTML (a paragraph ends at the next block, a list item at the next one, ...).
Paragraphs of text pass points for their length and commas to their ancestors, half as
many per level, discounted by link density. The container with most points is kept; where
an article encloses it, with the article's other blocks, else with those of its siblings
that are headings, plain paragraphs or score nearly as much. Lists of nothing but links
go. Scripts, forms, menus, headers outside the article, footers, sidebars, notices,
adverts and reader comments are cut by element, role or the words of a class or id: a
name counts if it is made of such words and of words of layout only, so a slug like
``related-work`` or ``ad-hoc-networks`` isn't one; headings are never cut by name, and
paragraphs and list items by few whole names only.

Character references are decoded; white space in a block becomes one space; blocks are
joined by two newlines in page order. Null, empty and text-free pages give an empty
text. Pages of any length are read whole, in time in proportion. Repeated rows are
extracted each, null ids and urls stay null; of containers with equal points the first
wins; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches

#: Elements by what they do.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CUT = frozenset("head script style noscript template iframe nav footer aside form button select option textarea input svg canvas object embed dialog menu audio video title xmp noembed noframes".split())
ENDS_P = BLOCK - {"body", "html"}
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that only a whole name of ``PLAIN`` cuts.
TEXTUAL = frozenset("p li dd dt td th tr tbody thead tfoot blockquote pre figure figcaption address summary".split())
#: Words of classes and ids. Of ``STRONG`` one in a class is enough; else a name
#: has to hold a word of either of the first two sets and no word outside the three.
STRONG = frozenset("advert adverts advertisement advertising adsense breadcrumb breadcrumbs commentlist comments disqus gdpr masthead nav navbar navigation newsletter pagination popup sidebar sponsored subscribe toolbar".split())
WEAK = frozenset("ad ads alert aside banner comment consent cookie cookies copyright foot footer header login menu modal notice overlay pager promo promotion recommendations recommended related replies reply respond search share sharing side signup skip social sponsor widget widgets".split())
LAYOUT = frozenset("area articles article bar block body bottom box buttons button center col column container content desktop entry fixed form global group head icons inline inner item items label latest left links link list main media mobile more outer page panel popular post posts primary read reader recent right row secondary section site slot sticky stories tools top unit user users wrap wrapper wp".split())
PLAIN = frozenset("ad ads advert advertisement breadcrumb breadcrumbs cookie-notice newsletter pagination sponsored".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split())
TITLED = frozenset("article entry post title text content story".split())
LIKELY = re.compile(r"(?:^|[\s_-])(?:article\w*|content|main|body|post|entry|story|text)(?=$|[\s_-])", re.I)
#: A quote opens a value only behind an equals sign; nothing is tried twice.
PIECE = re.compile(r"<!--(?:-?>|.*?(?:--!?>|$))|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"'][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[^\W_a-zA-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
LINKS = 0.9
LEAST = 25
KEEP_SHARE = 0.2


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "score", "bias", "scope")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False, bias: float = 0.0, scope: str = "") -> None:
        self.tag, self.parent, self.cut, self.score, self.bias = tag, parent, cut, 0.0, bias
        self.children: list = []
        self.scope = scope or (parent.scope if parent is not None else "")  # "article", "main" or neither: what encloses it


@functools.lru_cache(maxsize=1 << 16)
def _unlikely(name: str, is_id: bool, inside: bool) -> bool:
    """Whether a class or id names what isn't the article; a header may be one inside it."""
    words = [w.lower() for w in WORDS.findall(name)]
    marks = [w for w in words if w in STRONG or w in WEAK]
    if marks == ["header"] and (inside or any(w in TITLED for w in words)):
        return False
    if not is_id and any(w in STRONG for w in words):
        return True
    return bool(marks) and all(w in STRONG or w in WEAK or w in LAYOUT or w.isdigit() for w in words)


def _marks(tag: str, attributes: str, scope: str) -> tuple[bool, float, str]:
    """Whether an element is cut, how its own words weigh, and what scope it opens."""
    if tag in CUT or tag == "header" and not scope and not any(w.lower() in TITLED for w in WORDS.findall(attributes)):
        return True, 0.0, ""
    opens = tag if tag in ("article", "main") else ""
    names: list[tuple[str, bool]] = []
    if attributes:
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name == "class":
                names += [(x, False) for x in value.split()]
            elif name == "id" and value:
                names.append((value, True))
            elif name == "role":
                role = value.strip().lower()
                if role in ROLES:
                    return True, 0.0, ""
                opens = role if role in ("article", "main") else opens
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN.search(value):
                return True, 0.0, ""
    if tag in TEXTUAL:
        if any(x.lower() in PLAIN for x, is_id in names if not is_id):
            return True, 0.0, ""
    elif tag not in HEADINGS and tag not in ("body", "html", "article", "main") and any(_unlikely(x, is_id, bool(scope)) for x, is_id in names):
        return True, 0.0, ""
    elif tag == "article" and any(w.lower() in ("comment", "reply") for x, _ in names for w in WORDS.findall(x)):
        return True, 0.0, ""
    return False, 25.0 if opens else 15.0 if any(LIKELY.search(x) for x, _ in names) else 0.0, opens


def parse(page: str) -> Node:
    """The page's tree; texts are strings among the children."""
    root = here = Node("#", None)
    at, n = 0, len(page)
    while at < n:
        m = PIECE.search(page, at)
        if m is None:
            here.children.append(page[at:])
            break
        if m.start() > at:
            here.children.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "br" or tag == "p" and not _open(here, "p"):
                here.children.append(Node(tag, here))
                continue
            node = here
            while node is not root and node.tag != tag:
                if node.tag in BLOCK and tag not in BLOCK:
                    node = root  # an inline end never closes a block
                    break
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        if tag in ENDS_P:
            node = here
            while node is not root and node.tag != "p" and node.tag not in BLOCK:
                node = node.parent
            if node.tag == "p":
                here = node.parent
        if tag in IMPLIED:
            ends, within = IMPLIED[tag]
            node = here
            while node is not root and node.tag not in within:
                if node.tag in ends:
                    here = node.parent
                node = node.parent
        cut, bias, scope = _marks(tag, m[3], here.scope)
        node = Node(tag, here, cut, bias, scope)
        here.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|$)[^>]*(?:>|$)", re.I).search(page, at)
            if tag in ("textarea", "title"):
                node.children.append(page[at : end.start() if end else n])
            at = end.end() if end else n
        elif tag not in VOID:
            here = node
    return root


def _open(node: Node | None, tag: str) -> bool:
    while node is not None and node.tag != tag and node.tag not in ("table", "button", "#"):
        node = node.parent
    return node is not None and node.tag == tag


def blocks(root: Node) -> list[tuple[Node, str, int]]:
    """Blocks of text in page order: nearest block element, text, characters in links."""
    out: list[tuple[Node, str, int]] = []
    owner, parts, links = root, [], 0

    def close() -> None:
        nonlocal parts, links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((owner, text, links))
        parts, links = [], 0

    stack: list = [(root, False, iter(root.children), root)]
    while stack:
        node, in_link, rest, block = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            if node.tag in BLOCK:
                close()
            if stack:
                owner = stack[-1][3]
        elif isinstance(child, str):
            text = entities.unescape(child) if "&" in child else child
            parts.append(text)
            if in_link:
                links += len(" ".join(text.split()))
        elif child.cut:
            if child.tag in BLOCK:
                close()
        elif child.tag == "br":
            parts.append(" ")
        elif child.tag in BLOCK:
            close()
            owner = child
            stack.append((child, in_link, iter(child.children), child))
        else:
            stack.append((child, in_link or child.tag == "a", iter(child.children), block))
    close()
    return out


def main_text(page: str | None) -> str:
    """The article's text of one page."""
    found = blocks(parse(page)) if page else []
    if not found:
        return ""
    scored: dict[int, Node] = {}
    for node, text, links in found:
        density = min(1.0, links / len(text))
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - density) if len(text) >= LEAST else 0.2 * (1 - density)
        up, share = node if node.tag not in ("p", "li", "td", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote") else node.parent, 1.0
        while up is not None and share > 0.05:
            if id(up) not in scored:
                scored[id(up)] = up
                up.score = up.bias
            up.score += points * share
            up, share = up.parent, share / 2
    best = max(scored.values(), key=lambda x: x.score)
    scope = best
    while scope is not None and not (scope.tag == "article" or scope.bias == 25.0 and scope.scope == "article"):
        scope = scope.parent
    found = _without_menus(found, best)
    if scope is not None:
        return "\n\n".join(text for node, text, _ in found if _kept(node, {id(scope)}))
    keep, at = {id(best)}, best
    while at.parent is not None and at.tag not in ("body", "html", "main"):
        _keep_siblings(at, best.score, found, keep)
        at = at.parent
        if not best.scope or at.bias == 25.0:
            break  # without a main element only the siblings themselves count
    return "\n\n".join(text for node, text, _ in found if _kept(node, keep))


def _sums(found: list[tuple[Node, str, int]], of) -> dict[int, list]:
    """By node that ``of`` names for a block: the node, characters, characters in links, blocks."""
    sums: dict[int, list] = {}
    for node, text, links in found:
        if (top := of(node)) is not None:
            own = sums.setdefault(id(top), [top, 0, 0, 0])
            own[1] += len(text)
            own[2] += links
            own[3] += 1
    return sums


def _keep_siblings(at: Node, best: float, found: list[tuple[Node, str, int]], keep: set[int]) -> None:
    """Adds the siblings of ``at`` that belong to the article."""

    def sibling(node: Node | None) -> Node | None:
        while node is not None and node.parent is not at.parent:
            node = node.parent
        return node if node is not at else None

    for k, (node, size, links, _) in _sums(found, sibling).items():
        heading = node.tag in HEADINGS or node.tag in ("header", "div") and any(not isinstance(x, str) and x.tag == "h1" for x in node.children)
        if heading or node.score >= max(10, KEEP_SHARE * best) or node.tag == "p" and size > 80 and links < 0.25 * size:
            keep.add(k)


def _without_menus(found: list[tuple[Node, str, int]], best: Node) -> list[tuple[Node, str, int]]:
    """The blocks without lists of two or more links and hardly anything else."""

    def list_of(node: Node | None) -> Node | None:
        while node is not None and node.tag not in ("ul", "ol", "dl", "table"):
            node = node.parent
        return node if node is not best else None

    menus = {k for k, (_, size, links, n) in _sums(found, list_of).items() if n > 1 and links >= LINKS * size}
    return [x for x in found if not menus or id(list_of(x[0])) not in menus]


def _kept(node: Node | None, keep: set[int]) -> bool:
    while node is not None and id(node) not in keep:
        node = node.parent
    return node is not None


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(x.as_py()) for x in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars."""
    return bounded_batches(pages).select("page_id", "url", "html").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
