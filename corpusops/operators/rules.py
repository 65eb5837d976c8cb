"""Labelling texts by a list of regular expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.literals import required_literals, rules_to_try
from .frames import require

#: characters of pattern text per combined alternation
CHUNK_CHARS = 4000
#: up to this number all rules are run on every text
FEW_RULES = 100
# numbered and named references change meaning inside a combined pattern
_REFERENCE = re.compile(r"\\[1-9]|\\k<|\(\?<[A-Za-z]|\(\?P")


def _combined(rules: Sequence[str]) -> list[str]:
    """The rules as few alternations; rules with group references stay alone.

    The flags give classes such as ``\\w`` their Unicode meaning and end lines at ``\\n`` only.
    """
    chunks: list[list[str]] = []
    alone: list[str] = []
    size = CHUNK_CHARS
    for rule in rules:
        rule = rule.replace("(?P<", "(?<")
        if _REFERENCE.search(rule):
            alone.append(rule)
            continue
        if size + len(rule) > CHUNK_CHARS:
            chunks.append([])
            size = 0
        chunks[-1].append(f"(?:{rule})")
        size += len(rule)
    return [f"(?Ud){p}" for p in ["|".join(c) for c in chunks] + alone]


def matches_any(text: Column | str, rules: Sequence[str], few: int = FEW_RULES) -> Column:
    """True where at least one rule is found in the text.

    Rules are configuration: they become literals of the plan, compiled once per task. Up to ``few`` of them are tested in one scan of the
    text; beyond, a rule with a required literal is run only on texts that hold it, so the time hardly depends on their number.
    No join of texts with rules takes place at any number of rules, and the result is the same.
    """
    text = F.col(text) if isinstance(text, str) else text
    known = {i: found for i, r in enumerate(rules) if (found := required_literals(r))} if len(rules) > few else {}
    tests = [text.rlike(p) for p in _combined([r for i, r in enumerate(rules) if i not in known])]
    if known:
        patterns = F.lit([_combined([rules[i]])[0] for i in known])
        candidates = rules_to_try(text, [(at, *known[i]) for at, i in enumerate(known)])
        tests.append(F.exists(candidates, lambda at: F.rlike(text, F.get(patterns, at))))
    return reduce(or_, tests) if tests else F.lit(False)


def texts_matching(df: DataFrame, rules: Sequence[str], text: str = "content") -> DataFrame:
    """Rows whose text matches some rule."""
    return df.where(matches_any(text, rules))


def classify(
    df: DataFrame,
    rules: Sequence[str],
    text: str = "content",
    label_type: str = "positive",
    invert_negative: bool = False,
) -> DataFrame:
    """Add ``true_label`` (by ``label_type``) and ``predicted_label`` (1 where a rule matches).

    ``invert_negative=True`` swaps the prediction for ``label_type="negative"``.
    """
    require(df, text)
    positive = label_type == "positive"
    hit, miss = (0, 1) if invert_negative and not positive else (1, 0)
    found = F.coalesce(matches_any(text, rules), F.lit(False))
    return df.withColumns({
        "true_label": F.lit(1 if positive else 0),
        "predicted_label": F.when(found, hit).otherwise(miss),
    })
