"""Links and message text from HTML."""

from __future__ import annotations

import re
import sys
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

# executors need no copy of this package: the parser below travels with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# fixed values: HTML syntax
_TAG_REST = r"""(?:[^>"']++|"[^"]*"|'[^']*')*+>"""
_ANCHOR = rf"(?is)<a\s{_TAG_REST}.*?</a\s*>|<a\s{_TAG_REST}(?!.*</a)"
_HREF = r"""(?is)^<a(?:[^>"']*(?:"[^"]*"|'[^']*'))*?[^>"']*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_NO_MARKUP = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
_ANY_TAG = rf"(?s)<!--.*?-->|<[/!?A-Za-z]{_TAG_REST}|<[^>]*>"
_NUMBER = "#[0-9]++;?|#[xX][0-9a-fA-F]++;?"
_ENTITY = f"&(?:{_NUMBER}|[A-Za-z][A-Za-z0-9]*+;?)"
#: in attribute values a name without semicolon that ``=`` follows is a parameter of a query
_ATTRIBUTE_ENTITY = f"&(?:{_NUMBER}|[A-Za-z][A-Za-z0-9]*+(?:;|(?!=)))"
#: names that are known without a semicolon too, longest first
_LOOSE = "^(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"
_COMMON = ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;")
_LAST, _REPLACEMENT = 0x10FFFF, 0xFFFD


def _names() -> Column:
    """Map of the HTML 5 names, common ones first as a look-up goes through it from the start."""
    names = dict.fromkeys([*_COMMON, *sorted(html5)])
    return F.str_to_map(F.lit("\ue001".join(f"{n}\ue000{html5[n]}" for n in names)), F.lit("\ue001"), F.lit("\ue000"))


def _numbered(body: Column) -> Column:
    """Character of ``#123`` or ``#x7B``; U+FFFD for zero, surrogates and numbers above the last code point.

    Numbers from 128 to 159 mean what they mean in Windows-1252, where that has a character.
    """
    is_hex = body.rlike("^#[xX]")
    digits = F.regexp_replace(body, "^#[xX]?0*|;$", "")
    short = F.length(digits) <= F.when(is_hex, 6).otherwise(7)
    code = F.when(short, F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int"))
    code = F.coalesce(F.when((code > 0) & (code <= _LAST) & ~code.between(0xD800, 0xDFFF), code), F.lit(_REPLACEMENT))
    windows = F.array(*[F.lit(ord(bytes([i]).decode("cp1252", "ignore") or chr(i))) for i in range(128, 160)])
    code = F.when(code.between(128, 159), F.get(windows, code - 128)).otherwise(code)
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def unescape(text: Column, attribute: bool = False) -> Column:
    """Decode numeric and named (HTML 5) character references; what is no reference stays.

    Some names count without semicolon: in text also as the beginning of a longer word, in an ``attribute``
    only where no letter, digit or ``=`` follows.
    """
    pattern = _ATTRIBUTE_ENTITY if attribute else _ENTITY

    def named(body: Column) -> Column:
        whole = F.try_element_at(_names(), body)
        if attribute:
            return whole
        loose = F.regexp_extract(body, _LOOSE, 0)
        return F.coalesce(whole, F.when(loose != "", F.concat(F.try_element_at(_names(), loose), body.substr(F.length(loose) + 1, F.length(body)))))

    def decoded(entity: Column) -> Column:
        body = entity.substr(F.lit(2), F.length(entity))
        return F.coalesce(F.when(body.startswith("#"), _numbered(body)).otherwise(named(body)), entity)

    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), decoded)
    between = F.split(text, pattern, -1)
    joined = F.array_join(
        F.zip_with(between, found, lambda gap, c: F.concat(F.coalesce(gap, F.lit("")), F.coalesce(c, F.lit("")))), ""
    )
    return F.when(text.contains("&"), joined).otherwise(text)


def anchors(html: Column | str) -> Column:
    """Array of (link, text) for every anchor with an ``href``, in document order."""
    html = F.regexp_replace(F.col(html) if isinstance(html, str) else html, _NO_MARKUP, "")
    raw = F.filter(F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(0)), lambda a: a.rlike(_HREF))

    def parts(a: Column) -> Column:
        href = F.concat(*[F.regexp_extract(a, _HREF, i) for i in (1, 2, 3)])
        return F.struct(unescape(href, attribute=True).alias("link"), unescape(F.regexp_replace(a, _ANY_TAG, "")).alias("text"))

    return F.transform(raw, parts)


class _SubtreeText(HTMLParser):
    """Text of the first ``tag`` whose class attribute is exactly ``cls``."""

    # fixed values: elements without end tag, elements whose content is no text
    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
    SILENT = {"video", "script", "style", "template", "rt", "rp"}

    def __init__(self, tag: str, cls: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.cls = tag, cls
        self.depth = 0  # open elements named ``tag`` inside the subtree; 0 is outside
        self.done = False
        self.skipping = 0  # open silent elements
        self.parts: list[str] = []
        self.hrefs: list[str | None] = []

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if not self.depth:
            if tag == self.tag and dict(attrs).get("class") == self.cls:
                self.depth = 1
            return
        if tag == self.tag:
            self.depth += 1
        if tag in self.SILENT:
            self.skipping += 1
        elif self.skipping:
            return
        elif tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.hrefs.append(dict(attrs).get("href"))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in self.VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.done or not self.depth:
            return
        if tag in self.SILENT and self.skipping:
            self.skipping -= 1
        elif tag == "a" and self.hrefs and not self.skipping:
            self._close_anchor()
        elif tag == self.tag:
            self.depth -= 1
            self.done = self.depth == 0

    def _close_anchor(self):
        href = self.hrefs.pop()
        if href is not None:
            self.parts.append(f" ({href})")

    def handle_data(self, data):
        if self.depth and not self.done and not self.skipping:
            self.parts.append(data)


def _subtree_text(html: str | None, tag: str, cls: str) -> str:
    parser = _SubtreeText(tag, cls)
    parser.feed(html or "")
    parser.close()
    while parser.hrefs:  # anchors the page never closed
        parser._close_anchor()
    return re.sub(r"\s+", " ", "".join(parser.parts)).strip()


def subtree_text(html: Column | str, tag: str = "div", cls: str = P.MESSAGE_CLASS) -> Column:
    """Text of the first element with that tag and class; '' if there is none.

    Videos and scripts are dropped, line breaks become blanks, anchors become ``text (href)``. Nested elements
    of the same tag need balanced matching, which patterns cannot do, hence the Arrow-batched UDF.
    """

    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: _subtree_text(page, tag, cls))

    return extract(F.col(html) if isinstance(html, str) else html)
