"""Main text of pages: what counts as the article, and the contract on the given table."""

import re
from html import unescape

import pytest

from opsward.llm import html_extraction
from opsward.llm.html_extraction import SURGE, WINDOW, main_text, spans
from opsward.llm.queries import QUERIES

PROSE = "Plain words of prose go on for a while and then some more. " * 3
MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>'


def text(html):
    return main_text(html)[0]


@pytest.mark.parametrize(
    "html, wanted",
    [
        (None, ""),
        ("", ""),
        (MENU + "<article></article><footer>Imprint of the house</footer>", ""),
        (MENU + "<article><h1>A &amp; B</h1><p>x<p>One <b>bo</b>ld\n\t word&excl;</article><footer>f</footer>", "A & B x One bold word!"),
        ("<header><h1>Site</h1></header><main><p>Short.</p></main><aside>More</aside>", "Short."),
        ("<article><header><h1>T</h1></header><p>a</p><div class='ad'>buy</div><p>b</p><footer>tags</footer></article>", "T a b"),
        ("<article><p>a</p><section id='comments'><article><p>I disagree at great length. " + PROSE + "</p></article></section></article>", "a"),
        ("<div id='cookie-notice'>We use cookies.</div><div class='entry-content'><h2>T</h2><p>b</div><div class='sidebar'>" + PROSE + "</div>", "T b"),
        ("<article><p>a</p><form><label>Mail</label><input><button>Go</button></form><p>b</p><script>var t='</p>';</script><style>p{}</style></article>", "a b"),
        ("<nav>Never closed <article><p>kept</p></article>", "kept"),
        ("<article><p title='a > b'>q</p><!-- no --><p>r<br>s</p><p hidden>t</p></article>", "q r s"),
        ("<article>x<!-- the rest is gone <p>y</p></article>", "x"),
        ("<article><ul><li>one<li>two <a href='/'>link</a></ul><table><tr><td>c<td>d</table><pre>  e\n f </pre></article>", "one two link c d e f"),
        ("<article><p>1 < 2 &lt;b&gt; &amp;amp; &am &#x41;&#66;</p></article>", "1 < 2 <b> &amp; &am AB"),
        ("<body class='with-sidebar no-ads'><article class='post comments-open'><p>k</p></article></body>", "k"),
        ("<article><p>long " + PROSE + "</p></article><article><p>a teaser</p></article>", ("long " + PROSE).strip()),
    ],
)
def test_articles(html, wanted):
    assert text(html) == wanted


def test_unmarked_pages_surge_and_dive():
    menu = "<div>" + "<div><a href='/'>Somewhere else on this site</a></div>" * 9 + "</div>"
    page = f"<body>{menu}<div><h1>Headline</h1><p>{PROSE}</p><p>tiny</p><p>{PROSE}</p></div>{menu}<div>(c) us</div></body>"
    assert text(page) == f"Headline {PROSE}tiny {PROSE}".strip()
    assert main_text(page)[1] == 1
    assert text("<p>Hi</p>") == "Hi"


def test_spans_follow_the_window_sums():
    gap = [0] * WINDOW
    assert spans([], 1) == []
    assert spans([*gap, 5, 0, SURGE, 1, *gap, 3, *gap, SURGE], SURGE) == [(3, 6), (14, 14)]
    assert spans([*gap, 5, *gap, 7, 1], SURGE) == [(7, 8)]


def test_deep_and_broken_markup():
    assert text("<div>" * 5000 + "deep" + "</p></b>" * 5000) == "deep"
    assert text("<" * 2000) == "<" * 2000
    assert text("<article><p class=it's>it's</p><p a='>b</article>").startswith("it's")


def test_given_pages(spark):
    """Pages of the table hold their text in one article element of plain paragraphs."""
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    got = QUERIES["op13_html_extraction"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.DOTALL)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", body)]
        assert r.text == " ".join(b for b in blocks if b)
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


def test_odd_rows(spark):
    rows = [(1, "u", "<article>a", "x"), (1, "u", "<article>a", "x"), (None, None, None, None), (2, "v", "<p>" + "long " * 200_000, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extraction.extract_main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars", "n_spans"]
    assert sorted(((r.page_id, r.n_chars) for r in got.collect()), key=repr) == [(1, 1), (1, 1), (2, 999_999), (None, 0)]
    assert html_extraction.extract_main_text(pages, keep=("page_id", "text")).columns == ["page_id", "text", "text", "n_chars", "n_spans"]
    assert html_extraction.extract_main_text(pages.limit(0)).count() == 0
