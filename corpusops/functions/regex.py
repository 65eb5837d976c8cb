"""One entry point for regular-expression extraction, splitting and substitution."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column
from pyspark.sql import functions as F


def _java_replacement(replacement: str) -> str:
    """``\\1`` group references as ``$1``; literal dollar signs escaped."""
    return re.sub(r"\\(\d+)", r"$\1", replacement.replace("$", r"\$"))


def _found(text: Column, pattern: str, method: str, group: int) -> Column:
    if method in ("findall", "finditer"):
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    if method == "search":
        first = F.regexp_substr(text, F.lit(pattern))
        return F.array_compact(F.array(first))
    if method == "fullmatch":
        return F.array_compact(F.array(F.when(text.rlike(rf"\A(?:{pattern})\z"), text)))
    return F.split(text, pattern, -1)


def apply_regex(
    text: Column | str,
    pattern: str,
    method: str = "sub",
    *,
    flags: str = "",
    group: int = 0,
    unique: bool = False,
    as_list: bool = True,
    as_float: bool = False,
    when_none=None,
    when_one=None,
    when_many=None,
    pick: int | list[int] | None = None,
    border: str = "",
    separator: str = " + ",
    replacement: str = "",
) -> Column:
    """Apply ``pattern`` by one of findall, finditer, search, fullmatch, split, sub.

    ``sub`` gives the text, every other method an array of matches (``search`` and ``fullmatch``:
    none or one element). With ``as_list=False`` the array is reduced to one value: ``when_none``
    (or "0"), ``when_one`` (or the match), and for several matches ``when_many``, the one picked
    by index, or all of them joined by ``separator`` between two ``border`` strings. ``as_float``
    makes values doubles; what is no number becomes null. ``flags`` are inline flags such as "iu".
    An unknown method gives null.
    """
    text = F.col(text) if isinstance(text, str) else text
    if flags:
        pattern = f"(?{flags}){pattern}"
    if method == "sub":
        return F.regexp_replace(text, pattern, _java_replacement(replacement))
    if method not in ("findall", "finditer", "search", "fullmatch", "split"):
        warnings.warn(f"unsupported method: {method}", stacklevel=2)
        return F.lit(None).cast("string")

    kind = "double" if as_float else "string"
    found = _found(text, pattern, method, group)
    if unique:
        found = F.array_distinct(found)
    values = F.transform(found, lambda x: x.try_cast("double")) if as_float else found
    size = F.size(found)

    def picked() -> Column:
        indexes = pick if isinstance(pick, list) else [pick]
        # 0-based and negative indexes; those past the end are left out of a list
        at = [F.try_element_at(values, F.lit(i + 1 if i >= 0 else i)) for i in indexes]
        inside = [F.when(F.lit(i) < size, F.array(v)).otherwise(F.array().cast(f"array<{kind}>"))
                  for i, v in zip(indexes, at)]
        return F.concat(*inside)

    if as_list:
        result = values
        if pick is not None:
            result = F.when(size > 1, picked()).otherwise(result)
        if when_none is not None:
            result = F.when(size == 0, F.array(F.lit(when_none).cast(kind))).otherwise(result)
        return result

    none = F.lit(when_none if when_none is not None else "0").cast(kind)
    one = F.lit(when_one).cast(kind) if when_one is not None else F.try_element_at(values, F.lit(1))
    if when_many is not None:
        many = F.lit(when_many).cast(kind)
    elif isinstance(pick, int):
        many = F.try_element_at(picked(), F.lit(1))
    elif isinstance(pick, list):
        many = F.array_join(picked().cast("array<string>"), separator).try_cast(kind)
    else:
        many = F.concat(F.lit(border), F.array_join(found, separator), F.lit(border)).try_cast(kind)
    return F.when(size == 0, none).when(size == 1, one).when(size > 1, many)
