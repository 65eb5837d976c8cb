"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags. The first pass decides what it can: blocks inside menus,
headers, footers, sidebars, adverts, notices, forms and comments (by element, role and class names) and blocks of links are
boilerplate; long enough blocks with enough stop words are text. The second pass gives the rest (short blocks, blocks of few stop
words) the label of their nearest decided neighbours. Where the page marks its article, only blocks in it are
text and its edges (what is no part of it, adverts in it included) count as text; elsewhere the edges of the page count as boilerplate.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: stop words of English, French, German, Spanish
STOP_WORDS = frozenset("""
the of and to in is that it on as for with his at by this had not but be from they we an are was or have you her which
le la les des et un une du en que qui est dans pour pas sur au avec ce il elle se ne par plus son sont ou mais nous vous
der die das und ist nicht ein eine zu den von mit sich auf für als auch es dem war im wird aus bei nach wie noch ich sie
el los las y una por con no su para del lo más como pero sus sin sobre este ya cuando todo esta ser son dos también fue
""".split())

# fixed values: elements that begin a block; without end tag; whose content is no text; that are boilerplate, also inside an article
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp".split())
SILENT = frozenset("template svg object canvas audio video select button datalist map".split())
BOILERPLATE = frozenset("nav aside footer menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# fixed values: an open element of the first kind ends where one of the second begins, unless one of the third is between
ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"table"}),
            "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"}), "a": ({"a"}, BLOCKS)}
CONTAINERS = BLOCKS - {"p"} - HEADINGS
# fixed values: parts of class names and ids, and roles
BAD_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored promo promotion banner sidebar aside menu nav navbar
navigation breadcrumb breadcrumbs masthead topbar header footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter
subscribe subscription signup login comment comments commentlist disqus reply replies respond share sharing social related recommended
recommendations widget widgets toolbar pagination pager copyright disclaimer search skip tags""".split())
GOOD_NAMES = frozenset("article articlebody post entry story content maincontent main".split())
NEGATIONS = frozenset("has with no without is not hide".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?", re.I)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Rules:
    """Thresholds: characters of a short and of a long block, shares of stop words and of characters in links."""

    short: int = 70
    long: int = 200
    few_stop_words: float = 0.10
    many_stop_words: float = 0.20
    links: float = 0.33
    article_links: float = 0.5
    heading_reach: int = 200


@dataclass
class Block:
    text: str
    links: float
    bad: bool
    article: bool
    heading: bool
    label: str = field(default="")


@dataclass
class _Open:
    tag: str
    bad: str  # why it is boilerplate: "", "form" or "name"
    article: bool
    silent: bool
    link: bool


def _names(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether names and roles of an element say boilerplate, or article."""
    bad = good = False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            bad = True
        elif key == "role":
            bad, good = bad or value in BAD_ROLES, good or value in ("main", "article")
        elif key == "itemprop":
            good = good or value == "articlebody"
        elif key in ("class", "id"):
            for name in value.split():
                parts = [p for p in re.split(r"[-_:]+", name) if p]
                if not parts or parts[0] in NEGATIONS:
                    continue
                of_article = in_article or parts[0] in GOOD_NAMES
                if parts[-1] == "header" or parts[0] == "header":
                    bad = bad or not of_article
                elif parts[-1] in BAD_NAMES or parts[0] in BAD_NAMES:
                    bad = True
                elif parts[-1] in GOOD_NAMES or parts[0] in GOOD_NAMES:
                    good = True
    return (False, good) if tag in ("html", "body", "article", "main") and not (tag == "article" and bad) else (bad, good and not bad)


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page that hold text, in page order, references decoded and white space made one."""
    blocks: list[Block] = []
    stack: list[_Open] = []
    opened: Counter[str] = Counter()
    pieces: list[tuple[str, bool]] = []
    heading = False
    breaks = 0

    def top() -> _Open:
        return stack[-1] if stack else _Open("", "", False, False, False)

    def text(raw: str) -> None:
        nonlocal breaks
        if raw and not top().silent:
            pieces.append((unescape(raw) if "&" in raw else raw, top().link))
            if not raw.isspace():
                breaks = 0

    def end_block() -> None:
        nonlocal breaks
        breaks = 0
        if pieces:
            whole = " ".join("".join(p for p, _ in pieces).split())
            if whole:
                chars = sum(len("".join(p.split())) for p, _ in pieces)
                linked = sum(len("".join(p.split())) for p, link in pieces if link)
                blocks.append(Block(whole, linked / chars, bool(top().bad), top().article, heading))
            pieces.clear()

    def close(tag: str, stops: frozenset | set = frozenset()) -> bool:
        """Close the innermost open ``tag`` and all in it, if none of ``stops`` is open within."""
        if not opened[tag]:
            return False
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag == tag:
                opened.subtract(x.tag for x in stack[i:])
                del stack[i:]
                return True
            if stack[i].tag in stops:
                return False
        return False

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at, tag = m.end(), (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag in BLOCKS:
                end_block()
                close(tag, CONTAINERS if tag in ("p", *HEADINGS) else ENDED_BY[tag][1] if tag in ENDED_BY else ())
                heading = heading and tag not in HEADINGS
            elif opened[tag] and not close(tag, BLOCKS):
                i = max(i for i, x in enumerate(stack) if x.tag == tag)  # an inline element that blocks were opened in
                opened[tag] -= 1
                del stack[i]
            continue
        if tag in BLOCKS:
            end_block()
            close("p", CONTAINERS)
            heading = tag in HEADINGS
        elif tag == "br":
            breaks += 1
            if breaks > 1:
                end_block()
            else:
                pieces.append((" ", False))
        if tag in ENDED_BY:
            for ended in ENDED_BY[tag][0]:
                close(ended, ENDED_BY[tag][1])
        if tag in RAW:
            ending = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = ending.start() if ending else end
            continue
        if tag in VOID:
            continue
        outer = top()
        bad, good = _names(tag, m.group(3), outer.article)
        article = outer.article or good or tag in ("article", "main")
        why = outer.bad
        if tag in BOILERPLATE or bad or (tag == "header" and not article):
            why = "name"
        elif tag == "form" and not why:
            why = "form"
        elif why == "form" and tag in ("article", "main"):
            why = ""  # pages whose whole body is a form
        silent = outer.silent or tag in SILENT or (why != "" and tag not in BLOCKS and why != outer.bad)
        stack.append(_Open(tag, why, article, silent, outer.link or tag == "a"))
        opened[tag] += 1
    end_block()
    return blocks


def label_blocks(blocks: list[Block], rules: Rules) -> list[Block]:
    """Set every label to ``good`` or ``bad``, in two passes."""
    count = [(sum(w in STOP_WORDS for w in ws), len(ws)) for ws in (_WORD.findall(b.text.lower()) for b in blocks)]
    known = sum(s for s, _ in count) >= 0.02 * sum(n for _, n in count)  # else the page's language is none of the lists'
    has_article = any(b.article and not b.bad for b in blocks)
    for b, (stop, n) in zip(blocks, count):
        share = stop / n if n else 0.0
        if b.bad or (has_article and not b.article):
            b.label = "bad"
        elif has_article:
            linked = b.links > rules.article_links and len(b.text) < rules.long
            b.label = "bad" if linked else "good" if len(b.text) >= rules.short and share >= rules.few_stop_words else "short"
        elif b.links > rules.links or b.text.startswith("©"):
            b.label = "bad"
        elif len(b.text) < rules.short:
            b.label = "short"
        elif not known or share >= rules.many_stop_words:
            b.label = "good" if len(b.text) >= rules.long else "near"
        else:
            b.label = "near" if share >= rules.few_stop_words else "bad"
    edge = "good" if has_article else "bad"
    before, after, here = [""] * len(blocks), [""] * len(blocks), edge
    for i, b in enumerate(blocks):
        before[i] = here
        here = b.label if b.label in ("good", "bad") else here
        here = edge if has_article and (b.bad or not b.article) else here
    here, reach = edge, rules.heading_reach + 1
    heads = [False] * len(blocks)
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        after[i] = here
        heads[i] = b.heading and here == "good" and reach <= rules.heading_reach
        reach = 0 if b.label in ("good", "bad") else reach + len(b.text)
        here = b.label if b.label in ("good", "bad") else here
        here = edge if has_article and (b.bad or not b.article) else here
    for i, b in enumerate(blocks):
        if b.label in ("short", "near"):
            both = {before[i], after[i]}
            lenient = has_article or b.label == "near" or heads[i]
            b.label = "good" if both == {"good"} or (lenient and "good" in both) else "bad"
    return blocks


def main_text(html: str | None, rules: Rules = Rules()) -> str:
    return "\n".join(b.text for b in label_blocks(blocks_of(html or ""), rules) if b.label == "good")


def extract(pages: DataFrame, html: str = "html", rules: Rules = Rules(), into: str = "text") -> DataFrame:
    """The pages with a column of their main text: good blocks in page order, joined by one line feed.

    Null and empty pages, and pages without text, give ''. Pages of any length are read whole, each in one task; broken markup is
    read as browsers do: unknown end tags are ignored, open elements end with the page. Repeated rows
    come back as often, further columns stay (one named like ``into`` is replaced), empty tables give no rows.
    """
    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return column.map(lambda page: main_text(page, rules))

    return pages.withColumn(into, text(F.col(html).cast("string")))
