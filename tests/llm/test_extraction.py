"""Operator 6: block reading, the scan, and labelled pages that the weights haven't seen."""

import random
import re
import time

import pytest

from feedlens.llm import extraction, html_blocks
from feedlens.llm.html_blocks import blocks_of
from feedlens.llm.labelled_pages import pages

from .conftest import table_of


@pytest.fixture(scope="module")
def weights():
    return extraction.learn(pages(extraction.PAGES))


ARTICLE = "This is the first paragraph of the article &amp; it has several words. " * 3
PAGE = f"""<!DOCTYPE html><html><head><title>Site title</title><style>p{{}}</style><script>var a = "<p>not text</p>";</script></head><body>
<header><div class="logo">Site</div></header><nav><ul><li><a href="/">Home</a></li><li><a href="/x">News</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, please accept them all.</div><!-- <p>hidden</p> -->
<article><h1>Head  line</h1><p>{ARTICLE}</p><div class="ad">Buy this now at a low price.</div><p>Second&nbsp;part
 of it, <a href="#">with a link</a> and <b>bold</b> text.</p><form><label>Mail</label><input><button>Send</button></form><ul><li>One item of the list<li>Another item here</ul></article>
<section id="comments"><div class="comment"><p>I don't agree with this article at all, it is far too long for me to read.</p></div></section>
<aside class="sidebar"><h3>Related</h3><p>Other story that you may like to read today.</p></aside><footer>&copy; 2020 Site. All rights reserved.</footer></body></html>"""


def test_article_without_everything_else(weights):
    assert extraction.main_text(PAGE, weights) == "\n\n".join([
        "Head line", " ".join(ARTICLE.replace("&amp;", "&").split()), "Second part of it, with a link and bold text.",
        "One item of the list", "Another item here"])


def test_unseen_labelled_pages(weights):
    exact = 0
    sample = pages(300, seed=77)
    for page in sample:
        blocks = blocks_of(page)
        want = [b.text for b in blocks if b.text[0] == "x"]
        exact += extraction.main_text(page, weights) == "\n\n".join(want)
    assert exact / len(sample) > 0.9


@pytest.mark.parametrize("scores, want", [([], (0, 0)), ([-1, -2], (0, 0)), ([1, -3, 2, 2], (2, 4)), ([2, -1, 2], (0, 3)), ([1, -1, 1], (0, 1)), ([0, 1], (1, 2))])
def test_the_scan_finds_the_largest_sum(scores, want):
    assert extraction.region(scores) == want


def test_the_scan_against_all_regions():
    import random
    rng = random.Random(5)
    for _ in range(300):
        s = [rng.randint(-5, 5) for _ in range(rng.randint(0, 12))]
        a, b = extraction.region(s)
        assert sum(s[a:b]) == max([0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)])


@pytest.mark.parametrize("page", ["", "no markup at all", "<", "<p", "<p class='x", "a < b > c", "<p>a<p>b</div></p>", "<!-- open", "<script>open", "</p></p>",
                                  "<a title=\"x > y\">link</a>", "&am &#x; &lt;p&gt;", "<p>" * 3000, "<div class=\"" * 200, "\x00�<p>퟿"])
def test_broken_markup_never_fails(weights, page):
    assert isinstance(extraction.main_text(page, weights), str)


def test_attributes_may_hold_a_greater_sign():
    assert [b.text for b in blocks_of('<p title="a > b">text</p>')] == ["text"]


def test_tables_nulls_and_clashing_columns(spark):
    schema = "page_id bigint, url string, html string"
    rows = [(1, "u", PAGE), (2, None, None), (None, "u", ""), (3, "u", "<nav><a>menu</a></nav>"), (1, "u", PAGE)]
    df = spark.createDataFrame(rows, schema)
    got = extraction.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == 5
    assert all(r["n_chars"] == len(r["text"]) for r in got.collect())
    assert [r["text"] for r in got.where("page_id is null or page_id in (2, 3)").collect()] == ["", "", ""]
    assert extraction.extract(df.limit(0)).count() == 0
    assert table_of(extraction.extract(df.selectExpr("*", "1 as text", "2 as n_chars"))) == table_of(got)


@pytest.mark.parametrize("quote", ['"', "'"])
def test_a_long_attribute_is_no_text(quote):
    value = "<p>not text</p> > " * 300
    assert [b.text for b in blocks_of(f"<p>one</p><iframe srcdoc={quote}{value}{quote}></iframe><p>two</p>")] == ["one", "two"]
    assert [b.text for b in blocks_of(f"<p title={quote}open>one</p><p>two</p>")] == ["one", "two"]


def plain_tokens(page):
    """Each token searched for by the one pattern, which reads to the page's end for a tag that is never closed."""
    reader, at = html_blocks.Reader(), 0
    while m := html_blocks.TOKEN.search(page, at):
        reader.text(page[at:m.start()])
        at, name = m.end(), m.group(1) or m.group(3)
        if name and page[m.start() + 1] == "/":
            reader.end(name.lower())
        elif name:
            if name.lower() in html_blocks.RAW:
                stop = re.compile(f"</{name}", re.I).search(page, at)
                at = stop.start() if stop else len(page)
            reader.start(name.lower(), m.group(2) or m.group(4) or "")
    reader.text(page[at:])
    reader.close_block()
    return reader.blocks


def test_broken_pages_read_as_by_the_one_pattern():
    rng = random.Random(2)
    parts = ["<a ", '"', "'", ">", "<", "/", "</", "<p>", "<div class='x'>", '<div class="y">', "</div>", "</p>", "text ", " href=", "<!--", "-->",
             "<script>", "</script>", "<br/>", "<li>", "<ul>", "</ul>", "é", "&amp;", "<b>", "</b>", "<article>", "<main", "<!x"]
    for _ in range(8000):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(1, 16)))
        assert html_blocks.blocks_of(page) == plain_tokens(page), page


def test_pages_of_the_table_read_as_by_the_one_pattern(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").limit(300).collect()
    assert len(pages) >= 50
    for r in pages:
        assert html_blocks.blocks_of(r["html"] or "") == plain_tokens(r["html"] or "")


@pytest.mark.parametrize("page", ['<a ">"' * 160_000, '<a "' * 100_000, "<div>" * 50_000 + "</x>" * 50_000, "<a '\"" * 50_000,
                                  "<p>" + "<b>" * 50_000 + "</p>" * 50_000, "<div>" * 50_000 + "<p>x" * 20_000])
def test_long_broken_pages_take_linear_time(page):
    start = time.process_time()
    html_blocks.blocks_of(page)
    assert time.process_time() - start < 8
