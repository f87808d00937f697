"""Main-text extraction on hand-made pages and on the page table."""

import html
import re

import numpy as np
import pytest

from podium.llm import html_extract
from tests.conftest import SMOKE

NONE = np.zeros(html_extract.KINDS, np.float32)
BODY = "<p>A paragraph of the story with quite a few words in it.</p>"
CASES = [
    (None, ""), ("", ""), ("just text & more", "just text & more"),
    ("<article><h1>T</h1><p>a\n b&nbsp;&amp;&#233;<br>c</p><p>x</p></article>", "T\na b &é c\nx"),
    (f"<nav><li>Home</li></nav>{BODY}<footer>me</footer>", BODY[3:-4]),
    (f"<div class='site-menu'>Home News</div>{BODY}<div id=comments><p>I like it</p></div>", BODY[3:-4]),
    (f"<article>{BODY}<div class='ad'>Buy</div><p>End.</p><aside>More</aside></article>",
     BODY[3:-4] + "\nEnd."),
    (f"{BODY}<form>Mail <input></form><p>End.</p>", BODY[3:-4] + "\nEnd."),
    ("<article><p>one<p>two<ul><li>three<li>four</ul></article>", "one\ntwo\nthree\nfour"),
    ("<article><p><b>one<br><p>two", "one\ntwo"),
    ("<article><header><h1>T</h1></header><p>x y</p></article><header>Site</header>", "T\nx y"),
    ("<article><p>a<script>var t='</p>';</script>b</p><!-- no --></article><!-- cut", "a b"),
    ("<article><p>a &lt;b&gt; c</p><style>p{}", "a <b> c"),
    ("<p>a<SCRIPT>x</Script >b</p>", "a b"), ("<p>cut <", "cut <"), ("<p>cut <fo", "cut"),
    ("<p>1 < 2 &amp;&amp; 3</p>", "1 < 2 && 3"), ("<nav>only</nav>", ""), ("<p> </p>", ""),
]


@pytest.mark.parametrize("page,text", CASES)
def test_cases(page, text):
    assert html_extract.extract(page, NONE) == text


@pytest.mark.parametrize("attributes", ["style='overflow:hidden'", 'title="A hidden gem"', "data-hidden='false'",
                                        "data-class='menu'", "href=/hidden", "alt=' id=nav '"])
def test_only_attribute_names_hide(attributes):
    assert html_extract.extract(f"<article {attributes}>{BODY}</article>", NONE) == BODY[3:-4]
    for own in ("hidden", "HIDDEN=''", "aria-hidden='true'", "class=menu", "id='nav'"):
        page = f"<div {attributes} {own}>Home</div><article>{BODY}</article>"
        assert html_extract.extract(page, NONE) == BODY[3:-4]


def test_learned_weights_find_unlisted_boilerplate(spark):
    pages = [(i, "u", f"<div class='zq'>{'junk ' * 30}</div><article><p>story {i}</p></article>")
             for i in range(20)] + [(99, "u", f"<div class='zq'>{'junk ' * 30}</div><p>story of a page</p>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_pages(frame).collect()}
    assert got[3] == "story 3" and got[99] == "story of a page"


def test_rows_and_long_pages(spark):
    long = "<article>" + "<p>some words here</p>" * 20000 + "</article>"
    rows = [(1, None, long, "c"), (1, None, long, "c"), (2, "u", None, "c"), (None, "u", "<p>x</p>", "c")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r["page_id"] or 0, r["n_chars"]) for r in html_extract.extract_pages(frame).collect())
    assert got == [(0, 1), (1, 16 * 20000 - 1), (1, 16 * 20000 - 1), (2, 0)]
    assert html_extract.extract_pages(frame.limit(0)).count() == 0


def test_page_table_equals_its_articles(spark):
    pages = spark.read.parquet(f"{SMOKE}/pages.parquet")
    want = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)
        parts = re.split(r"</?(?:p|h1)[^>]*>", body[1]) if body else []
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " " if "<br>" in x else "", x)).split())
                 for x in parts]
        want[r["page_id"]] = "\n".join(x for x in parts if x)
    got = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages).collect()}
    assert got == want


def test_an_element_that_holds_the_article_is_no_boilerplate():
    import numpy as np
    none = np.zeros(html_extract.KINDS, np.float32)
    body = "<p>The article text is here and goes on for some words.</p>"
    want = "The article text is here and goes on for some words."
    for page in (f'<div class="layout has-sidebar"><article>{body}</article></div>',
                 f'<div id="page-no-header"><main>{body}</main></div>',
                 f'<section class="post comments-closed"><article>{body}</article></section>'):
        assert html_extract.extract(page, none) == want
    # a part that is named so stays out, even with an article inside
    comments = '<section class="comments"><article><p>First! A reader comment of some words, and more.</p></article></section>'
    assert html_extract.extract(f"<main>{body}</main>{comments}", none) == want
    assert html_extract.extract(f'<div class="has-sidebar"><main>{body}</main><div class="left-sidebar"><p>menu one two</p></div></div>',
                                none) == want


def test_deep_nesting_takes_linear_time():
    import time

    import numpy as np
    none = np.zeros(html_extract.KINDS, np.float32)
    inner, outer = np.zeros(html_extract.KINDS, np.int64), np.zeros(html_extract.KINDS, np.int64)
    page = "<main>" + "<div>word " * 40_000 + "</x></b>" * 2000
    start = time.process_time()
    assert html_extract.extract(page, none).count("word") == 40_000
    html_extract.count_kinds(page, inner, outer)
    assert inner.max() == 40_000 and time.process_time() - start < 20
