"""Channel names and domains from links."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def channel_name(link: Column | str) -> Column:
    """Channel of a ``t.me`` link, else the host without ``www.`` and a common top-level domain.

    The ``t.me`` test is a substring test, so a host that merely contains it takes that branch too.
    """
    link = F.col(link) if isinstance(link, str) else link
    handle = F.substring_index(F.substring_index(link, f"{P.TELEGRAM}/", -1), "/", 1)
    host = F.regexp_extract(link, P.SITE_HOST, 2)
    return (
        F.when(link.contains(P.TELEGRAM), F.when(handle == "", P.UNKNOWN_TELEGRAM).otherwise(handle))
        .when(host == "", P.UNKNOWN_CHANNEL)
        .otherwise(F.regexp_replace(host, P.COMMON_TLD, ""))
    )


def authority(link: Column | str) -> Column:
    """Authority part of a url with port and user info; empty for relative and opaque links."""
    return F.regexp_extract(F.col(link) if isinstance(link, str) else link, P.AUTHORITY, 1)


def is_external(link: Column | str, own_domains: Iterable[str]) -> Column:
    """True where the link names a host outside ``own_domains`` (exact, case-sensitive)."""
    host = authority(link)
    return (host != "") & ~host.isin(sorted(set(own_domains)))


def is_message_link(link: Column | str) -> Column:
    return (F.col(link) if isinstance(link, str) else link).contains(P.TELEGRAM)


def embed_link(link: Column | str) -> Column:
    """Address of the embeddable page of a message link; other links unchanged."""
    link = F.col(link) if isinstance(link, str) else link
    return F.when(is_message_link(link), F.concat(link, F.lit(P.EMBED_SUFFIX))).otherwise(link)
