import html as library
import re
import time

import pytest
from conftest_llm import by_id
from entidex.llm import html
from entidex.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><p>Site header text that is long enough to look like an article, really long text.</p></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>A &amp; B</h1><p>First   paragraph<br>goes &lt;on&gt; <b>here</b>.<p>Unclosed one
<aside>Side</aside><form><input value="x">Subscribe</form><div class="ad">Buy</div>
<ul><li>item one<li>item two</ul><p>Short.</p><section class="comments"><p>I disagree!</p></section></article>
<div id="sidebar">More links</div><footer>&copy; us</footer></body></html>"""


def test_article_blocks():
    assert html.main_text(PAGE) == "A & B\n\nFirst paragraph goes <on> here.\n\nUnclosed one\n\nitem one\n\nitem two\n\nShort."


def test_page_without_article_uses_the_distribution():
    body = "".join(f"<p>Paragraph {i} with quite a few words that make up the main text of this page.</p>" for i in range(4))
    page = f"<body><div><a href='/a'>one</a></div><div></div><div></div><div></div><div>{body}</div><div></div><div></div><div></div><div>tiny</div></body>"
    assert html.main_text(page) == "\n\n".join(f"Paragraph {i} with quite a few words that make up the main text of this page." for i in range(4))


LONG = "A paragraph with quite a few words that make up the main text of this page, all of it."


@pytest.mark.parametrize("page, blocks", [
    (f"<div><div><h2>Title</h2></div></div><div><div><p>{LONG}</p></div></div><div><div><p>Short.</p></div></div>", ["Title", LONG, "Short."]),
    (f"<div><p>One</p></div><div><p>Two</p></div><div><p>Three</p></div><div><p>Four</p></div><div><p>{LONG}</p></div>", ["One", "Two", "Three", "Four", LONG]),
    ("<body><div><p>A whole short article.</p></div></body>", ["A whole short article."]),
    (f"<div class='layout has-sidebar'><p>{LONG}</p><div class='sidebar'>Side</div></div>", [LONG]),
    (f"<div class='content with-comments'><article><p>{LONG}</p></article></div>", [LONG]),
    (f"<div class='widget'><article><p>{LONG}</p><div class='ad'>Buy</div></article></div><div class='related'>More</div>", [LONG]),
    (f"<article><p>{LONG}</p></article><div class='related'><article>Teaser</article></div>", [LONG]),
])
def test_wrapped_and_short_blocks_stay(page, blocks):
    assert html.main_text(page) == "\n\n".join(blocks)


def test_surges_choose_on_pages_with_article_elements():
    """The body beside teaser cards stays, the cards and short lines beside an article do not."""
    cards = "".join(f"<article><p>Card {i}</p><a href='/{i}'>Read on</a></article>" for i in range(3))
    for page in (f"<div><p>{LONG}</p><p>{LONG}</p></div><div>{cards}</div>", f"<div>{cards}</div><div><p>{LONG}</p><p>{LONG}</p></div>"):
        assert html.main_text(page) == f"{LONG}\n\n{LONG}"
    assert html.main_text(f"<div>Home</div><article><p>{LONG}</p></article><div>Top</div>") == LONG


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<script>x</script>", "<article></article>", "<"])
def test_pages_without_text(page):
    assert html.main_text(page) == ""


def test_cut_pages():
    for at in range(PAGE.index("<article>") + 9, PAGE.index("</article>")):
        text = html.main_text(PAGE[:at])
        assert "cookies" not in text and "<p" not in text and "Side" not in text


def test_long_page_takes_linear_time():
    assert len(html.main_text("<article>" + "<p>word word</p>" * 100_000 + "</article>")) > 1_000_000
    html.main_text("<article>" + "<" * 50_000 + "\"'" * 20_000)


HOSTILE = ["<a ", '<a "', '<a ">"', "<a<", "<a '\">", '</a "', "<script ", "<!-- ", "<div hidden><article>", "<div class=ad><article>x", '<a class="', "<b>x</i>"]


@pytest.mark.parametrize("piece", HOSTILE)
@pytest.mark.parametrize("tail", ["", ">", '"', "</p>" * 50_000])
def test_hostile_pages_take_linear_time(piece, tail):
    page = piece * (500_000 // len(piece)) + tail
    start = time.process_time()
    html.main_text(page)
    assert time.process_time() - start < 5


def test_closing_tags_over_deep_nesting_take_linear_time():
    start = time.process_time()
    assert html.main_text("<div>" * 100_000 + LONG + "</p></b>" * 100_000) == LONG
    assert time.process_time() - start < 5


@pytest.mark.parametrize("tag, text", [
    ('<p title="a > b">', LONG),
    ("<p title='a > \"b\"'>", LONG),
    ('<p title="never closed>', LONG),
    ("<p title=it's>", LONG),
    ("<p\nclass=x\t>", LONG),
    ("1 < 2 and ", "1 < 2 and " + LONG),
    ("a <b", "a"),
])
def test_ends_of_tags(tag, text):
    rest = "" if tag == "a <b" else LONG
    assert html.main_text(f"{tag}{rest}") == text


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 7), (1, "u", PAGE, 7), (2, None, None, 8), (None, "v", "", 9)], "page_id long, url string, html string, text int")
    size = len(html.main_text(PAGE))
    assert by_id(html.with_url(pages), "page_id", "url", "n_chars") == [(None, "v", 0), (1, "u", size), (1, "u", size), (2, None, 0)]
    assert html.with_url(pages.filter("false")).collect() == []


def plain(page):
    """The given template taken apart by hand."""
    body = page[page.index("<article>") + 9 :].split("</article>")[0]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*\Z", "", body).replace("<br>", " "))
    texts = (" ".join(library.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def test_query(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op8_html_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        text = plain(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, text, len(text))
