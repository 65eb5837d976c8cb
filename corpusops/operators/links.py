"""Links out of HTML articles and the text of the message pages they lead to."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.html import anchors, subtree_text
from ..functions.urls import embed_link, is_external, is_message_link


def extract_links(df: DataFrame, html: str = "text", key: str = "nid", carry: Iterable[str] = ("created_at",)) -> DataFrame:
    """(key, index, text, link) of every anchor; the index counts all links of an article.

    Columns in ``carry`` that exist (the article date) come along.
    """
    extra = [c for c in carry if c in df.columns]
    rows = df.select(key, *extra, F.posexplode(anchors(html)).alias("index", "__a"))
    return rows.select(key, "index", F.col("__a.text").alias("text"), F.col("__a.link").alias("link"), *extra)


def external_links(links: DataFrame, own_domains: Iterable[str], link: str = "link") -> DataFrame:
    """Drop relative links, opaque links and links to the publisher's own domains."""
    return links.where(is_external(link, own_domains))


def page_texts(
    pages: DataFrame, url: str = "url", html: str = "html", tag: str = "div", cls: str = P.MESSAGE_CLASS, fetched: str | None = None
) -> DataFrame:
    """(url, page_text), one row per address: that of the last fetch, by the column ``fetched``, and of it the alphabetically last.

    Pages without a time come before all others. Only the page that is kept is parsed if ``fetched`` is given.
    """
    if fetched is None:
        return (
            pages.select(F.col(url).alias("url"), subtree_text(html, tag, cls).alias("page_text"))
            .groupBy("url").agg(F.max("page_text").alias("page_text"))
        )
    last = F.row_number().over(Window.partitionBy("url").orderBy(F.col("__at").desc_nulls_last(), F.col("__html").desc_nulls_last()))
    kept = pages.select(F.col(url).alias("url"), F.col(html).alias("__html"), F.col(fetched).alias("__at")).withColumn("__last", last).where("__last = 1")
    return kept.select("url", subtree_text("__html", tag, cls).alias("page_text"))


def link_texts(links: DataFrame, texts: DataFrame, link: str = "link", output: str = "extracted_text") -> DataFrame:
    """Add the text of the fetched page of each message link.

    Other links give '', a page that was not fetched gives the literal failure text. The left join
    carries no hint; a link that a third of the rows share is split by the skew-join rule.
    """
    # rows without a page get a key of their own each: equal (null) keys would share one task
    nowhere = F.concat(F.lit("#"), F.xxhash64(*links.columns).cast("string"))
    address = F.when(is_message_link(link), embed_link(link)).otherwise(nowhere)
    joined = links.withColumn("__url", address).join(
        texts.select(F.col("url").alias("__url"), "page_text"), "__url", "left")
    text = (
        F.when(~F.coalesce(is_message_link(link), F.lit(False)), "")
        .otherwise(F.coalesce(F.col("page_text"), F.lit(P.FETCH_FAILED)))
    )
    return joined.withColumn(output, text).drop("__url", "page_text")
