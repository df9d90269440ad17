"""Main text: hand-made pages with what an article may hold and what may stand in it."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from cohortspark.llm import main_text

LONG = "A sentence of the article, with commas, and with enough words, that counts as text of its own; number {}."
PARAS = [LONG.format(i) for i in range(8)]
BODY = "".join(f"<p>{x}</p>" for x in PARAS)


def blocks(page):
    return main_text.main_text(page).split("\n\n")


def test_quotes_open_a_value_only_behind_an_equals_sign():
    page = f"<article><p>{PARAS[0]} <a href=x title=it's>link</a> more</p><p>{PARAS[1]}</p><p data-x='a>b' title=\"c>d\">{PARAS[2]}</p><p title=\"it's\">{PARAS[3]}</p></article>"
    assert blocks(page) == [f"{PARAS[0]} link more", *PARAS[1:4]]
    assert blocks(f"<article><p class=\"open>{PARAS[0]}</p><p>{PARAS[1]}</p></article>")[-1] == PARAS[1]


@pytest.mark.parametrize("name", ["article-comments", "main-nav", "comments", "sidebar", "site-footer", "cookie-notice", "ad", "ad-slot-2", "related-posts", "share-buttons", "social-links", "newsletter-signup", "readerComments", "breadcrumb"])
@pytest.mark.parametrize("attribute", ["class", "id"])
def test_cut_inside_the_article(name, attribute):
    page = f"<body><article><h1>Title</h1>{BODY}<div {attribute}=\"{name}\"><p>Something that, with commas, and length, isn't the article, though it reads so.</p></div></article></body>"
    assert blocks(page) == ["Title", *PARAS]


@pytest.mark.parametrize("open_, close", [
    ("<section class='related-work'>", "</section>"), ("<section id='social-history'>", "</section>"), ("<div id='ad-hoc-networks'>", "</div>"), ("<div class='text-header'>", "</div>"),
    ("<div id='cookie-recipes'>", "</div>"), ("<div class='entry-header'>", "</div>"), ("<header>", "</header>"), ("<div data-id='nav' title='the hidden menu'>", "</div>"),
])
def test_kept_inside_the_article(open_, close):
    page = f"<body><article>{BODY}{open_}<h2>Heading</h2><p>Short words.</p>{close}</article></body>"
    assert blocks(page) == [*PARAS, "Heading", "Short words."]


@pytest.mark.parametrize("tag", ["<p class='text-header'>Words.</p>", "<h2 id='related-work'>Words.</h2>", "<h2 class='nav'>Words.</h2>", "<blockquote class='menu'>Words.</blockquote>", "<ul class='list'><li class='share'>Words.</li></ul>"])
def test_no_text_is_cut_for_a_style_word(tag):
    assert blocks(f"<article>{BODY}{tag}</article>") == [*PARAS, "Words."]


def test_title_beside_a_wrapped_body():
    body = "".join(f"<p>{x}</p>" for x in PARAS * 5)
    for page in (f"<article><h1>T</h1><div class='body'>{body}</div></article>", f"<main><h1>T</h1><div class='body'>{body}</div></main>", f"<div id='post'><h1>T</h1><div class='body'>{body}</div></div>", f"<div role='article'><header><h1>T</h1></header><div>{body}</div></div>"):
        assert blocks(page) == ["T", *(PARAS * 5)]


def test_around_the_article():
    noise = "<p>Words, and words, and more words that, sadly, look like text of an article.</p>"
    page = f"""<body><header>{noise}</header><div role=banner>{noise}</div><nav>{noise}</nav><ul><li><a href=/>Home</a><li><a href=/b>Blog</a></ul>
<div class="content-wrapper"><article>{BODY}<ul><li><a href=1>One more</a><li><a href=2>And another</a></ul><ul><li>An item, not a link<li>Second</ul><section id=comments><article class=comment>{noise}</article></section>
<div hidden>{noise}</div><div style="display: none">{noise}</div><div aria-hidden=true>{noise}</div><form>{noise}</form><aside>{noise}</aside><footer>{noise}</footer></article></div>
<div class="sidebar">{noise}</div><div id=disqus_thread>{noise}</div><footer>{noise}</footer></body>"""
    assert blocks(page) == [*PARAS, "An item, not a link", "Second"]


def test_references_and_white_space():
    assert blocks("<article><p>&lt;b&gt; &amp;amp; &eacute;&#233;&#x41; a\n\n b<br>c &am<i>p; x</i></p><pre>x\n  y</pre></article>") == ["<b> &amp; ééA a b c &amp; x", "x y"]


def test_time_grows_with_the_page():
    for piece in ("<a href='x", "<p class=\"", "<", "<!--", "<div>", "= ' \" ", "<a b=c d=", "</div>"):
        took = []
        for n in (4_000, 32_000):
            began = time.perf_counter()
            main_text.main_text(piece * n)
            took.append(time.perf_counter() - began)
        assert took[1] < 0.5 or took[1] < 24 * took[0], piece


def test_edge_rows(spark):
    """Null and repeated ids, null pages, very long pages, clashing names, an empty table."""
    long = "<article>" + BODY * 2000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", f"<article>{BODY}</article>"), (3, "u", long), (4, "v", "<p>x"), (4, "v", "<p>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("text", "n_chars", "a.b")})
    got = sorted((tuple(r) for r in main_text.extract(pages).collect()), key=str)
    whole = "\n\n".join(PARAS * 2000)
    want = [(1, "u", "", 0), (2, None, "", 0), (None, "u", "\n\n".join(PARAS), len("\n\n".join(PARAS))), (3, "u", whole, len(whole)), (4, "v", "x", 1), (4, "v", "x", 1)]
    assert got == sorted(want, key=str)
    assert main_text.extract(pages.where("false")).count() == 0
