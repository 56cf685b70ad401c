import itertools
import random

import numpy as np
import pytest

from tidemark.llm import extraction
from tidemark.llm.html_blocks import page_blocks

PAGES = "page_id long, url string, html string, text string, x string"
NONE = np.zeros(extraction.FEATURES)


def cost(side, source, sink, edges):
    return (
        sum(sink[k] if s else source[k] for k, s in enumerate(side))
        + sum(c for a, b, c in edges if side[a] != side[b])
    )


@pytest.mark.parametrize("seed", range(60))
def test_cuts_are_minimal(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    source = [rng.choice([0, rng.randint(0, 20)]) for _ in range(n)]
    sink = [rng.choice([0, rng.randint(0, 20)]) for _ in range(n)]
    edges = [(a, b, rng.randint(0, 8)) for a in range(n) for b in range(a) if rng.random() < 0.5]
    side = extraction.maximum_flow(source, sink, edges)
    best = min(cost(s, source, sink, edges) for s in itertools.product([False, True], repeat=n))
    assert cost(side, source, sink, edges) == best


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body>
<nav><ul><li><a href=x>Home</a></li><li><a href=y>About</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better, and so on.</p></div>
<header><h2>Site name</h2></header>
<article><header class=entry-header><h1>A &amp; title</h1></header>
<p><b>First&nbsp;para
graph &lt;x&gt; &eacute;&#233;.<br><p>Second <i>one</i>, with a <a href=z>link</a>.<ul><li>an item<li>another item</ul>
<div class="ad">Buy something, it is good for you and for us.</div>
<form><label>Name</label><input><p>Fill this in, please.</p></form>
<style>p{}</style><!-- comment -->
<p>Last words.</p>
<section id="comments"><h3>Comments</h3><p>I liked this article very much, thank you.</p></section>
</article>
<aside class="sidebar"><p>Read also this long and interesting sentence of ours.</p></aside>
<footer>&copy; Someone<p>All that is left.</footer></body></html>"""


def test_a_page_with_everything():
    assert extraction.main_text(PAGE, NONE).split("\n\n") == [
        "A & title",
        "First para graph <x> éé.",
        "Second one, with a link.",
        "an item",
        "another item",
        "Last words.",
    ]


@pytest.mark.parametrize(
    "html", [None, "", "   ", "<", "<p", "</p></div>", "<p>", "<script>never ends", "<a><a><a>", "&#xD800;&bogus;", "<!--", "\x00"]
)
def test_broken_pages_do_not_fail(html):
    assert isinstance(extraction.main_text(html, NONE), str)


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + "text" + "</div>" * 3000
    assert [b.text for b in page_blocks(deep)] == ["text"]
    long = "<article>" + "<p>A sentence of some words, as they come.</p>" * 20_000 + "</article>"
    assert extraction.main_text(long, NONE).count("\n\n") == 19_999


def test_smoothness_carries_a_weak_block():
    page = "<main><p>{0}</p><p>{0}</p><p>Yes</p><p>{0}</p></main>"
    weights = NONE.copy()
    weights[0], weights[2] = -8.0, 4.0  # short texts look like boilerplate
    text = "A long and proper sentence of an article."
    assert "Yes" in extraction.main_text(page.format(text), weights)


def test_tables_with_nulls_and_repeats(spark):
    rows = [(1, "u", PAGE, "old", "x"), (1, "u", PAGE, "old", "x"), (None, None, None, None, None), (2, "v", "", "", "")]
    pages = spark.createDataFrame(rows, PAGES)
    got = extraction.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"] > 0) for r in got) == [(0, False), (1, True), (1, True), (2, False)]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extraction.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_fit_separates_what_can_be_separated():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(400, extraction.FEATURES))
    rows[:, 0] = 1
    content = rows[:, 2] + 0.2 > 0
    weights = extraction.fit(rows, content)
    assert ((rows @ weights > 0) == content).mean() > 0.95
    assert not extraction.fit(rows, np.ones(400, bool)).any()


def test_held_out_pages_equal_their_markup(spark):
    """The fixture's pages name their article; what is extracted must be all of it."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in extraction.op3_html_extraction(spark, "/root/testdata/sf0.01").collect()}
    block = re.compile(r"</?(?:p|h1|div|ul|li|table|tr|td)\b[^>]*>")
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in block.split(article)]
        assert texts[r["page_id"]] == "\n\n".join(x for x in parts if x)


ARTICLE = """<nav><a href=x>Home</a></nav><div class="{1}"><article class="{2}"><h1>Title</h1>
<p>A first sentence of the article.</p><p>A second sentence of it.</p></article></div>
<div class="sidebar"><p>Read also this.</p></div><footer>All that is left.</footer>"""


@pytest.mark.parametrize("body", ["", "single has-sidebar", "no-sidebar", "no-banner", "sidebar", "modal-open"])
@pytest.mark.parametrize("box", ["", "content-with-sidebar", "sidebar", "related"])
@pytest.mark.parametrize("article", ["", "post has-comments", "post comments", "notice"])
def test_names_around_an_article_do_not_lose_it(body, box, article):
    page = f'<html class="{body}"><body class="{body}">{ARTICLE.format("", box, article)}</body></html>'
    want = "Title\n\nA first sentence of the article.\n\nA second sentence of it."
    assert extraction.main_text(page, NONE) == want


@pytest.mark.parametrize("name", ["discussion", "related-work", "notice", "legal"])
def test_the_classifier_outweighs_a_name(name):
    text = "A long and proper sentence of an article, as others are."
    page = f'<article><p>{text}</p><section id="{name}"><h2>Yes</h2><p>{text}</p><p>{text}</p></section></article>'
    weights = NONE.copy()
    weights[0], weights[2] = -8.0, 6.0  # long texts look like content, short ones do not
    found = extraction.main_text(page, weights).split("\n\n")
    assert found.count(text) == 3
    assert extraction.main_text(page, NONE) == text  # without evidence the name decides


P = "<p>A first sentence of the article.</p><p>A second sentence of it.</p>"
BOTH = "A first sentence of the article.\n\nA second sentence of it."
FORM = '<form id="aspnet" action="/x"><input type="hidden" name="s">{}<input type="submit" value="Go"></form>'


@pytest.mark.parametrize(
    "page, want",
    [
        # a page inside one form, with and without an element that names its article
        (f"<body>{FORM.format(f'<nav>Home</nav><article>{P}</article><footer>End</footer>')}</body>", BOTH),
        (f"<body>{FORM.format(f'<h1>Title</h1>{P}')}</body>", f"Title\n\n{BOTH}"),
        (f"<body><nav>Home</nav>{FORM.format(P)}</body>", BOTH),
        # a form inside an article, or beside one, goes with all it holds
        (f"<article>{P}{FORM.format('<label>Name</label><p>Write us a letter, please.</p>')}</article>", BOTH),
        (f"{FORM.format(f'<p>{120 * "Long terms. "}</p>')}<article>{P}</article>", BOTH),
        # inline marks that are not shown or read lose their own text alone
        ('<article><h1><span aria-hidden="true">#</span> Title</h1>' + P + "</article>", f"Title\n\n{BOTH}"),
        ('<article><h1>Title <a aria-hidden="true" href="#t">¶</a></h1>' + P + "</article>", f"Title\n\n{BOTH}"),
        ("<article><p>One <span hidden>not this</span>two <b style='color:red; display: none'>nor this</b>three.</p></article>", "One two three."),
        ('<article><p hidden>No.</p><div style="display:none"><p>Nor this.</p></div>' + P + "</article>", BOTH),
        # an open dialog marks the page behind it; an address is not the end of an article
        (f'<div id="app" aria-hidden="true"><main><article>{P}</article></main></div>', BOTH),
        # comments as articles of their own, beside, inside and nested
        (f'<article class="post">{P}</article><section class="comments"><article class="comment-body"><p>{40 * "I liked it. "}</p></article></section>', BOTH),
        (f'<main><article>{P}</article><div id="comments"><ol><li><article class="comment-body"><div class="comment-content"><p>I liked this article.</p></div></article></li></ol></div></main>', BOTH),
        (f'<article>{P}<section id="comments"><article><p>Me too, I liked it very much.</p><article><p>So did I, thank you.</p></article></article></section></article>', BOTH),
        (f'<article>{P}<article class="comment"><p>I liked this article very much.</p></article></article>', BOTH),
    ],
)
def test_forms_hidden_marks_and_comments(page, want):
    if "<article" in page:
        assert extraction.main_text(page, NONE) == want
    weights = NONE.copy()
    weights[2] = 3.0  # texts look like content: that brings no comments and forms back
    assert extraction.main_text(page, weights) == want
