"""Main text of pages with and without a marked article, and of broken markup."""

import random
import time

import pytest
from pyspark.sql import functions as F

from corpusops.llm import html_main_text
from corpusops.llm.html_main_text import main_text
from corpusops.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LONG = ("The first of the paragraphs that is in it, with the words of the text and more of them as it was on that day for you. "
        "It was not the last of them, and from this one they had all that is in the page with it and by the others.")


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<p", ""), ("<!-- only", ""), ("<script>var a = '<p>no</p>'</script>", ""),
    ("<article><p>a &lt;b&gt; &#233;&nbsp;\n <!-- x --> c</article>", "a <b> é c"),
    ("<article><h1>T</h1><p><b>one<br><p>two &amp three", "T\none\ntwo & three"),
    ("<article><p>x <b>y<p>z</b> w</article>tail", "x y\nz w"),
    ("<form id=all><nav>menu</nav><article><p>kept</p><form>mail <input></form></article></form>", "kept"),
    ("<article><p>one</p><div class='ad-slot'>buy</div><ul><li><a href=1>More</a><li><a href=2>News</a></ul><p>two</p><footer>by</footer></article>", "one\ntwo"),
    ("<article>in<section id=comments><article class=comment><p>nice</p></article></section></article>", "in"),
    ("<main><p title='a > b'>q</p><p hidden>h</p><p style='display: none'>n</p></main>", "q"),
    ("<div class='post-content'><div class=post-header>Title</div><p>Text</p></div><div class=site-footer><p>foot</p></div>", "Title\nText"),
    ("<body class='single with-sidebar'><div class=article-body>x</div><div id=sidebar>y</div>", "x"),
    ("<article><p>%%% *** ###</p><p>&copy; kept</p></article>", "%%% *** ###\n© kept"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    ("<article><p>one<br><br>two<br>three</article>", "one\ntwo three"),
    ("<article><svg><title>s</title><text>t</text></svg><p>a<span class=ad>buy</span>b</p></article>", "ab"),
])
def test_marked_articles(page, want):
    assert main_text(page) == want


def test_pages_without_article_are_judged_by_words_and_neighbours():
    page = (f"<div><a href=1>Home</a> <a href=2>News</a></div><h1>Heading</h1><p>{LONG}</p><p>Short and between.</p><p>{LONG}</p>"
            "<p>Alone at the end.</p><ul><li><a href=3>Next</a></ul><p>© 2024 all the rights that are in it are with us and with them, as it was</p>")
    assert main_text(page) == "\n".join(["Heading", LONG, "Short and between.", LONG])
    assert main_text("<p>tiny</p>") == ""
    foreign = "<p>" + "Juba kreen dlo mavit sirra pont. " * 12 + "</p>"
    assert main_text(foreign) == ("Juba kreen dlo mavit sirra pont. " * 12).strip()


def test_second_pass_takes_the_nearest_decided_label():
    block = html_main_text.Block
    rows = [block("short", 0, False, False, False), block(LONG, 0, False, False, False), block("short", 0, False, False, False),
            block("links", 1, False, False, False), block("short", 0, False, False, False), block(LONG, 0, False, False, False)]
    assert [b.label for b in html_main_text.label_blocks(rows, html_main_text.Rules())] == ["bad", "good", "bad", "bad", "bad", "good"]


def test_any_markup_is_read_in_linear_time():
    pick = random.Random(5)
    parts = ["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<a href='x'>", "</a>", "<li>", "<ul>", "</ul>", "x", "&amp;", "&#xD800;", "<!--", "-->", "<script>",
             "</script>", "<article>", "</article>", "<table>", "<td>", "'", '"', "<", "=", ">", "<a title='", "<br>", " ", "\n", "<p class=", "<![CDATA["]
    for _ in range(5000):
        main_text("".join(pick.choice(parts) for _ in range(pick.randint(0, 40))))
    start = time.time()
    for deep in ("<a " * 50_000, "<b>" * 50_000 + "x" + "</b>" * 50_000, "<div>" * 50_000 + "x", "<!--" * 50_000, "<b>" * 20_000 + "</i>" * 20_000, "<a x='" * 50_000):
        main_text(deep)
    assert time.time() - start < 20


def test_query_rows(spark):
    pages = {r.page_id: r for r in spark.read.parquet(SMALL + "/pages.parquet").collect()}
    for r in QUERIES["op13_two_pass_blocks"](spark, SMALL).collect():
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text) > 0
        assert r.text == main_text(pages[r.page_id].html)


def test_pages_awkward_rows(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 100_000
    rows = [(1, None, "a"), (1, None, "a"), (2, "", None), (None, "<article>x</article>", "b"), (3, long, "c")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string").withColumn("label", F.lit("clash"))
    got = html_main_text.extract(pages, into="main").collect()
    assert sorted((r.page_id or 0, len(r.main)) for r in got) == [(0, 1), (1, 0), (1, 0), (2, 0), (3, 100_000 * 12 - 1)]
    assert html_main_text.extract(pages).columns == pages.columns
    assert html_main_text.extract(pages.limit(0)).count() == 0
