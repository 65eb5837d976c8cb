"""Substrings that a text must hold for a pattern to match, and the search for many of them at once."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: shorter literals do not tell texts apart
LEAST = 3
_SPECIAL = set(".^$[]()|?*+{}\\")
_QUANTIFIER = re.compile(r"[?*+][?+]?|\{(\d+)(?:,\d*)?\}[?+]?")


class _Unknown(Exception):
    """Syntax whose literals are not worked out."""


def _fold_char(c: str) -> str:
    """What case-insensitive matching compares: lower case of upper case, one character each."""
    upper = c.upper()
    lower = (upper if len(upper) == 1 else c).lower()
    return lower if len(lower) == 1 else lower[0]


class _Folding(dict):
    def __missing__(self, code: int) -> str:
        self[code] = out = _fold_char(chr(code))
        return out


_FOLDING = _Folding()


def fold_case(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_FOLDING)


def _skip_class(p: str, i: int) -> int:
    """End of the character class that opens at ``i``; classes may be nested."""
    depth = 0
    while i < len(p):
        if p[i] == "\\":
            i += 1
        elif p[i] == "[":
            depth += 1
        elif p[i] == "]":
            depth -= 1
            if not depth:
                return i + 1
        i += 1
    raise _Unknown


def _better(a: list[str] | None, b: list[str] | None) -> list[str] | None:
    """The set whose shortest member is longer."""
    if not a or not b:
        return a or b
    return a if min(map(len, a)) >= min(map(len, b)) else b


def _alternatives(p: str, i: int) -> tuple[list[str] | None, int]:
    """Literals of which one is in every match of the alternatives from ``i`` to a closing bracket or the end."""
    found: list[str] | None = []
    while True:
        branch, i = _sequence(p, i)
        found = None if found is None or not branch else found + branch
        if i < len(p) and p[i] == "|":
            i += 1
        else:
            return found, i


def _sequence(p: str, i: int) -> tuple[list[str] | None, int]:
    best: list[str] | None = None
    run = ""

    def end_run() -> None:
        nonlocal best, run
        best = _better(best, [run] if run else None)
        run = ""

    while i < len(p) and p[i] not in "|)":
        c, char, group = p[i], None, None
        if c == "(":
            head = re.compile(r"\((\?:|\?<?[=!]|\?<[A-Za-z]\w*>|\?>)?").match(p, i)
            if p[i + 1:i + 2] == "?" and not head.group(1):
                raise _Unknown
            group, i = _alternatives(p, head.end())
            if p[i:i + 1] != ")":
                raise _Unknown
            i += 1
            if head.group(1) in ("?=", "?!", "?<=", "?<!"):
                group = None
        elif c == "[":
            i = _skip_class(p, i)
        elif c == "\\":
            code = p[i + 1:i + 2]
            if code in "Qxu0cNpPkX" or not code:
                if code in ("p", "P"):
                    i += 2
                    i = p.index("}", i) + 1 if p[i:i + 1] == "{" else i + 1
                else:
                    raise _Unknown
            else:
                char = code if not code.isalnum() else None
                i += 2
        elif c in ".^$":
            i += 1
        elif c in "?*+{":
            raise _Unknown
        else:
            char = c
            i += 1
        quantifier = _QUANTIFIER.match(p, i)
        if quantifier:
            i = quantifier.end()
            optional = quantifier.group()[0] in "?*" or quantifier.group(1) in ("0", "00")
            if char and not optional:
                run += char
            elif optional:
                group = None
            end_run()
        elif char:
            run += char
            continue
        else:
            end_run()
        if group:
            best = _better(best, group)
    end_run()
    return best, i


def required_literals(rule: str) -> tuple[list[str], bool] | None:
    """(literals, whether case is ignored): every text that the rule is found in holds one of them. None if that is not known.

    A literal has at least ``LEAST`` characters. Flags other than a leading ``(?i)`` and rare syntax are not worked out.
    """
    ignore = rule.startswith("(?i)")
    body = rule[4:] if ignore else rule
    try:
        found, i = _alternatives(body, 0)
    except (_Unknown, ValueError):
        return None
    if i != len(body) or not found or min(map(len, found)) < LEAST:
        return None
    return ([fold_case(x) for x in found] if ignore else found), ignore


def rules_to_try(text: Column, literals: Sequence[tuple[int, list[str], bool]]) -> Column:
    """Indexes of the rules of which a literal occurs in the text; (index, literals, whether case is ignored) for each rule.

    One pass of an Aho-Corasick automaton over the text (two, if some rules ignore case), however many rules there are.
    """
    by: tuple[dict[str, list[int]], dict[str, list[int]]] = ({}, {})
    for index, words, ignore in literals:
        for word in words:
            by[ignore].setdefault(word, []).append(index)
    shared: list = []

    def automata():
        if not shared:
            import ahocorasick

            for words in by:
                made = ahocorasick.Automaton()
                for word, indexes in words.items():
                    made.add_word(word, indexes)
                if words:
                    made.make_automaton()
                shared.append(made if words else None)
        return shared

    @F.pandas_udf("array<int>")
    def search(texts: pd.Series) -> pd.Series:
        exact, folded = automata()

        def found(t: str | None) -> list[int] | None:
            if t is None:
                return None
            out: set[int] = set()
            for machine, own in ((exact, t), (folded, folded and fold_case(t))):
                if machine is not None and own:
                    for _, indexes in machine.iter(own):
                        out.update(indexes)
            return sorted(out)

        return texts.map(found)

    return search(text)
