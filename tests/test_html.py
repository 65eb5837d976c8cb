import pytest

from corpusops.functions import html as H
from corpusops.operators import links as L
from corpusops.plans.extract import extract_message_texts

MESSAGE = '<div class="tgme_widget_message_text js-message_text">'


@pytest.mark.parametrize("html, found", [
    ('<a href="/a">x</a> <A HREF=\'b\'>y<b>z</b></A>', [("/a", "x"), ("b", "yz")]),
    ('<a name="n">x</a><a class=c href=d>y</a>', [("d", "y")]),
    ('<a href="?a=1&amp;b=2">&laquo;т&raquo; &#1090;&#x442; &nope;</a>', [("?a=1&b=2", "«т» тт &nope;")]),
    ('<!-- <a href="no">x</a> --><script>"<a href=\'no\'>"</script><a href="">p</a>', [("", "p")]),
    ('<a data-href="no">x</a>', []),
    ('<a href="x">line\nbreak</a>', [("x", "line\nbreak")]),
    ('<a title="a>b" href="/x">t</a>', [("/x", "t")]),
    ("<a title=' href=no' href=/x>t<img alt='>'></a>", [("/x", "t")]),
    ('<a href="?a=1&copy=2&amp=3&lt;">&copy 1 &notit; &apos;&check;</a>', [("?a=1&copy=2&amp=3<", "© 1 ¬it; '✓")]),
    ('<a href="">&#9999999;&#xD800;&#0;&#150;&#00000065;&#x41 &#99999999999999999999;&#;&</a>', [("", "���–AA �&#;&")]),
    ("", []),
    (None, None),
])
def test_anchors(values, html, found):
    got = values(H.anchors, [html])[0]
    assert (None if got is None else [tuple(a) for a in got]) == found


@pytest.mark.parametrize("html, text", [
    (f'<p>no</p>{MESSAGE}one<br>two <a href="h">link</a>\n <div>in</div> end</div><p>no</p>', "one two link (h) in end"),
    (f"{MESSAGE}a<video>v<img></video><img src=x>b</div>", "ab"),
    (f"{MESSAGE}first</div>{MESSAGE}second</div>", "first"),
    ('<div class="js-message_text tgme_widget_message_text">order</div>', ""),
    ('<div class="tgme_widget_message_text">x</div>', ""),
    (f"{MESSAGE}&laquo;a&raquo;<script>s</script> <br/>b", "«a» b"),
    (f'{MESSAGE}<a href="h">open</div>', "open (h)"),
    (f"{MESSAGE}</div>", ""),
    ("", ""),
    (None, ""),
])
def test_subtree_text(values, html, text):
    assert values(H.subtree_text, [html]) == [text]


def test_subtree_of_other_element(values):
    assert values(lambda v: H.subtree_text(v, "p", "x"), ['<p class="x">a<div>b</div></p>']) == ["ab"]


def test_extraction(spark):
    articles = spark.createDataFrame([(7, (
        '<a href="https://own.org/">own</a><a href="/rel">rel</a><a href="https://t.me/c/1">one</a>'
        '<a href="https://t.me/c/2">two</a><a href="https://x.y/z">site</a>'), "2024-01-01")], "nid long, text string, created_at string")
    page = f"{MESSAGE}text of one</div>"
    pages = spark.createDataFrame([("https://t.me/c/1?embed=1&mode=tme", page)] * 2, "url string, html string")
    links, texts = extract_message_texts(articles, pages, {"own.org"})
    assert [tuple(r) for r in links.orderBy("index").collect()] == [
        (7, 2, "one", "https://t.me/c/1", "2024-01-01"), (7, 3, "two", "https://t.me/c/2", "2024-01-01"),
        (7, 4, "site", "https://x.y/z", "2024-01-01")]
    assert [r["extracted_text"] for r in texts.orderBy("index").collect()] == ["text of one", "Error loading", ""]


def test_rows_without_page_do_not_share_a_join_key(spark):
    links = spark.range(50).selectExpr("id nid", "0 index", "'t' text", "'https://x.y' link")
    pages = spark.createDataFrame([], "url string, page_text string")
    joined = L.link_texts(links, pages)
    assert joined.where("extracted_text = ''").count() == 50
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan
