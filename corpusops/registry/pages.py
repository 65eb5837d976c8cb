"""Queries of the HTML operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import links as L
from ..plans.extract import extract_message_texts
from .base import query, spread, table

_ENTITIES = [("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")]


def _decode(text: str) -> str:
    for entity, char in _ENTITIES:
        text = f"replace({text}, '{entity}', '{char}')"
    return text


def _articles(spark, sf_dir):
    """pages as articles; hrefs are relative, so the article's host is put before them."""
    host = F.regexp_extract("url", r"^https?://[^/]+", 0)
    html = F.regexp_replace("html", F.lit('href="/'), F.concat(F.lit('href="'), host, F.lit("/")))
    return spread(table(spark, sf_dir, "pages")).select(F.col("page_id").alias("nid"), html.alias("text"), "url")


_LINKS = rf"""arts AS (SELECT page_id AS nid, regexp_extract_all(regexp_replace(html, 'href="/', 'href="' || regexp_extract(url, '^https?://[^/]+') || '/', 'g'), '<a href="[^"]*">[^<]*</a>') AS anchors FROM pages),
flat AS (SELECT nid, unnest(range(len(anchors))) AS index, unnest(anchors) AS a FROM arts),
links AS (SELECT nid, CAST(index AS INTEGER) AS index, {_decode("regexp_extract(a, '>([^<]*)<', 1)")} AS text, {_decode("regexp_extract(a, '\"([^\"]*)\"', 1)")} AS link FROM flat)"""


@query(f"WITH {_LINKS.replace('arts AS', 'arts AS ', 1)} SELECT * FROM links")
def extract_links(spark, sf_dir):
    return L.extract_links(_articles(spark, sf_dir))


_OWN = ["ththre.example.com", "thther.example.org"]


@query(rf"""WITH {_LINKS} SELECT * FROM links WHERE regexp_extract(link, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) NOT IN ('', '{_OWN[0]}', '{_OWN[1]}')""")
def external_links(spark, sf_dir):
    return L.external_links(L.extract_links(_articles(spark, sf_dir)), _OWN)


@query(rf"""SELECT page_id, {_decode(r"trim(regexp_replace(regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1), '[\t-\r\x1C-\x20\x85\p{Z}]+', ' ', 'g'))")} AS page_text FROM pages""")
def div_text(spark, sf_dir):
    from ..functions.html import subtree_text
    return spread(table(spark, sf_dir, "pages")).select("page_id", subtree_text("html", "div", "ad").alias("page_text"))


# message links to the pages themselves, in thirds: fetched, not fetched, no message link
_MESSAGES = "msgs AS (SELECT page_id AS nid, CASE page_id % 3 WHEN 0 THEN 'https://t.me/p/' || page_id WHEN 1 THEN 'https://t.me/gone/' || page_id ELSE url END AS link FROM pages)"


@query(rf"""WITH {_MESSAGES} SELECT m.nid, m.link, CASE m.nid % 3 WHEN 0 THEN {_decode(r"trim(regexp_replace(regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1), '[\t-\r\x1C-\x20\x85\p{Z}]+', ' ', 'g'))")}
  WHEN 1 THEN 'Error loading' ELSE '' END AS extracted_text FROM msgs m JOIN pages ON page_id = nid""")
def link_page_join(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages"))
    kind, page = F.col("page_id") % 3, F.col("page_id").cast("string")
    link = F.when(kind == 0, F.concat(F.lit("https://t.me/p/"), page)).when(kind == 1, F.concat(F.lit("https://t.me/gone/"), page)).otherwise(F.col("url"))
    fetched = pages.select(F.concat(F.lit("https://t.me/p/"), page, F.lit("?embed=1&mode=tme")).alias("url"), "html")
    links = pages.select(F.col("page_id").alias("nid"), link.alias("link"))
    return L.link_texts(links, L.page_texts(fetched, tag="div", cls="ad")).select("nid", "link", "extracted_text")


_DIV = _decode(r"trim(regexp_replace(regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1), '[\t-\r\x1C-\x20\x85\p{Z}]+', ' ', 'g'))")


@query(rf"""WITH {_LINKS}, told AS (SELECT nid, index, text, regexp_replace(link, '^https?://([^/]+)/', 'https://t.me/\1/') AS link FROM links),
fetched AS (SELECT regexp_replace(url, '^https?://([^/]+)/.*', 'https://t.me/\1/The', 's') AS link, max({_DIV}) AS page_text FROM pages GROUP BY 1)
SELECT nid, index, text, link, coalesce(page_text, 'Error loading') AS extracted_text FROM told LEFT JOIN fetched USING (link)""")
def message_texts(spark, sf_dir):
    """Whole extraction: links of every page, and the text of the pages they lead to."""
    articles = _articles(spark, sf_dir)
    text = F.regexp_replace("text", "href=\"https?://([^/\"]+)/", "href=\"https://t.me/$1/")
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.regexp_replace("url", "https?://([^/]+)/.*", "https://t.me/$1/The"), F.lit("?embed=1&mode=tme")).alias("url"), "html")
    return extract_message_texts(articles.withColumn("text", text), pages, _OWN, tag="div", cls="ad")[1]
