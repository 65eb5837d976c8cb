"""Links of HTML articles and the text of the linked message pages, in one job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..functions import patterns as P
from ..operators.links import external_links, extract_links, link_texts, page_texts


def extract_message_texts(
    articles: DataFrame,
    pages: DataFrame,
    own_domains: Iterable[str],
    html: str = "text",
    key: str = "nid",
    tag: str = "div",
    cls: str = P.MESSAGE_CLASS,
) -> tuple[DataFrame, DataFrame]:
    """(links, links with text) from articles and a table of already fetched pages (url, html)."""
    links = external_links(extract_links(articles, html, key), own_domains)
    return links, link_texts(links, page_texts(pages, tag=tag, cls=cls))
