"""Columns and helpers that several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: what separates words: space, tab, line feed, vertical tab, form feed, carriage return
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(value: Column) -> Column:
    return F.translate(value, UPPER, LOWER)


def words(text: Column | str) -> Column:
    """The words of a text in order; none for a null text."""
    return F.filter(F.split(text_or_empty(text), SPACE_RUN), lambda w: w != "")


def count_words(text: Column | str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))


@contextmanager
def configured(spark, settings: dict[str, str]) -> Iterator[None]:
    """Within it, the session has these settings; then those of before."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_freed(spark):
    """Within it, the shuffle files of a query are deleted when the query ends, not when the driver next collects garbage."""
    return configured(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def small_batches(spark, rows: int = 512):
    """Within it, queries hand rows to Python so many at once, not 10,000: an executor and its Python processes hold whole batches."""
    return configured(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
