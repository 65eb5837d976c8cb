"""Row-local text functions, all as JVM column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P


def _col(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def squeeze(text: Column | str) -> Column:
    """Collapse whitespace runs to one blank and trim."""
    return F.trim(F.regexp_replace(_col(text), P.LOOSE_SPACE, " "))


def lower(text: Column | str) -> Column:
    return F.lower(_col(text))


def or_empty(text: Column | str) -> Column:
    return F.coalesce(_col(text), F.lit(""))


# cleaning steps ------------------------------------------------------------------------------------

def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, P.HTML_TAG, "")


def strip_zero_width(text: Column) -> Column:
    for char in P.ZERO_WIDTH:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def nbsp_to_blank(text: Column) -> Column:
    return F.replace(text, F.lit("&nbsp;"), F.lit(" "))


def strip_long_tokens(text: Column) -> Column:
    return F.regexp_replace(text, P.LONG_TOKEN, " ")


def strip_pictographs(text: Column) -> Column:
    return F.regexp_replace(text, P.PICTOGRAPH, " ")


def strip_hashtags(text: Column) -> Column:
    return F.regexp_replace(text, P.HASHTAG, " ")


def strip_emails(text: Column) -> Column:
    return F.regexp_replace(text, P.EMAIL, " ")


def strip_mentions(text: Column) -> Column:
    return F.regexp_replace(text, P.MENTION, " ")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, P.URL, " ")


def strip_at_and_slash(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("@"), F.lit(" ")), F.lit("/"), F.lit(" "))


def space_sentences(text: Column) -> Column:
    return F.regexp_replace(text, P.GLUED_SENTENCE, "$1 $2")


#: (step, substrings without which the step cannot change a text), in the order they apply
_CLEANING = [
    (strip_tags, ["<"]),
    (strip_zero_width, []),
    (nbsp_to_blank, []),
    (strip_long_tokens, []),
    (strip_pictographs, []),
    (strip_hashtags, ["#"]),
    (strip_emails, ["@"]),
    (strip_mentions, ["@"]),
    (strip_urls, ["http", "www."]),
    (strip_at_and_slash, []),
    (space_sentences, []),
    (squeeze, []),
]


def clean_text(text: Column | str, legacy_email: bool = False) -> Column:
    """Remove markup, invisible characters, ids, pictographs, tags, addresses and links.

    ``legacy_email=True`` leaves e-mail addresses to the mention step, which keeps the local part.
    """
    result = _col(text)
    for step, _ in _CLEANING:
        if not (legacy_email and step is strip_emails):
            result = step(result)
    return result


def compute_once(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Add (or replace) a costly column that later filters may refer to.

    The optimizer moves a filter below a projection by copying the column's expression into it, so
    the work is done twice. It does not move filters below a generator; ``stack(1, x)`` is one.
    """
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.stack(F.lit(1), value).alias("__once")).withColumnRenamed("__once", column)


def clean_column(
    df: DataFrame, column: str, output: str = "cleaned_text_column", legacy_email: bool = False
) -> DataFrame:
    """``clean_text`` over a column, for whole tables.

    A step whose trigger substring is absent is skipped: a byte search is far cheaper than the
    pattern. Each guard sits in a projection of its own, so the text before it is computed once.
    """
    df = df.withColumn(output, F.col(column))
    for step, needles in _CLEANING:
        if legacy_email and step is strip_emails:
            continue
        text = F.col(output)
        result = step(text)
        if needles:
            possible = reduce(or_, [text.contains(n) for n in needles])
            result = F.when(possible, result).otherwise(text)
        if step is squeeze:
            return compute_once(df, output, result)
        df = df.withColumn(output, result)


# words and sentences ------------------------------------------------------------------------------

def word_count(text: Column | str) -> Column:
    """Number of maximal runs of letters, digits and underscores; a null text counts as one word."""
    return F.coalesce(F.regexp_count(_col(text), F.lit(P.WORD_RUN)), F.lit(1))


def tokens(text: Column | str) -> Column:
    """Split on whitespace, without empty tokens."""
    return F.filter(F.split(_col(text), f"{P.SPACE}+"), lambda w: w != "")


def terms(text: Column | str) -> Column:
    """Lower-cased words of two or more characters, as the bag-of-words features use them."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(P.TERM_RUN), F.lit(0))


def sentences(text: Column | str) -> Column:
    """Split after a sentence end followed by whitespace; null gives an empty array."""
    return F.filter(F.split(strip_ends(or_empty(text)), P.SENTENCE_GAP), lambda s: s != "")


def strip_ends(text: Column | str) -> Column:
    return F.btrim(_col(text), F.lit(P.SPACE_CHARS))


def drop_words(text: Column | str, words: Iterable[str]) -> Column:
    """Drop the listed words (case-sensitive), keep repeats of the others, join by one blank."""
    listed = sorted(set(words))
    if not listed:
        return F.array_join(tokens(text), " ")
    return F.array_join(F.filter(tokens(text), lambda w: ~w.isin(listed)), " ")


def drop_members(items: Column, unwanted: Column) -> Column:
    """Drop array members that are in ``unwanted`` (null means none) and join by one blank."""
    unwanted = F.coalesce(unwanted, F.array().cast("array<string>"))
    return F.array_join(F.filter(items, lambda x: ~F.array_contains(unwanted, x)), " ")


def keep_alphabet(text: Column | str, alphabet: str = P.CYRILLIC) -> Column:
    """Delete characters other than the alphabet, digits, dots and whitespace.

    ``alphabet`` is what stands between the brackets of a character class.
    """
    kept = P.SPACE[1:-1]
    return squeeze(F.regexp_replace(_col(text), rf"[^{alphabet}\p{{Digit}}.{kept}]", ""))


def letters_only(text: Column | str, alphabet: str = P.CYRILLIC + P.LATIN) -> Column:
    """Everything but letters becomes one blank."""
    # in two steps, so that the lone blanks between words need no change
    spaced = F.regexp_replace(_col(text), rf"[^ {alphabet}]+", " ")
    return F.trim(F.regexp_replace(spaced, "  +", " "))


def tidy_punctuation(text: Column | str, alphabet: str = P.CYRILLIC + P.LATIN) -> Column:
    """Keep letters, digits and dots that follow a digit; pull dots to the word before them."""
    space = P.SPACE[1:-1]
    result = F.regexp_replace(_col(text), rf"[^{alphabet}\p{{Digit}}.:{space}]", " ")
    result = F.regexp_replace(result, rf"{P.SPACE}+\.(?={P.NON_SPACE})", ".")
    result = F.regexp_replace(result, rf"(?<=\D){P.SPACE}+\.(?=\D)", ".")
    result = F.regexp_replace(result, r"(?<!\d)\.|:", "")
    return squeeze(result)
