"""Column and row operators on news tables. Columns that are absent are skipped at plan time."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_dates
from ..functions.text import word_count
from ..functions.urls import channel_name


def _present(df: DataFrame, columns: Iterable[str | None]) -> list[str]:
    return [c for c in columns if c and c in df.columns]


def require(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    return df


# projections ----------------------------------------------------------------------------------------

def adopt_single_column(df: DataFrame, name: str = "content") -> DataFrame:
    """The only column of a one-column table becomes ``content``."""
    return df.toDF(name) if len(df.columns) == 1 else df


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def standard_names(
    df: DataFrame, content: str = "summary", date: str = "date", link: str = "link", link_name: str = "link"
) -> DataFrame:
    """Rename the given columns to content, date and link (or url)."""
    return rename_present(df, {content: "content", date: "date", link: link_name})


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Constant columns such as label and source name."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def with_long_id(df: DataFrame, column: str = "nid") -> DataFrame:
    return df.withColumn(column, F.col(column).try_cast("long"))


def with_default(df: DataFrame, column: str, source: str) -> DataFrame:
    """Fill a missing column from another one."""
    return df if column in df.columns else df.withColumn(column, F.col(source))


def filled_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The listed columns that exist and hold a value. Each look stops at the first value found."""
    return [c for c in _present(df, columns) if df.where(F.col(c).isNotNull()).select(c).take(1)]


def select_filled(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*filled_columns(df, columns))


def with_channel(df: DataFrame, link: str = "link", channel: str = "channel") -> DataFrame:
    """Derive the channel from the link unless the table has one."""
    return df if channel in df.columns else df.withColumn(channel, channel_name(link))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union by column name; a source without a column gives nulls."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# filters --------------------------------------------------------------------------------------------

def drop_nulls(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows with a null in any of the columns that exist (text, link, date by default)."""
    present = _present(df, columns or ("content", "link", "date"))
    return df.na.drop(subset=present) if present else df


def null_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows each column alone makes ``drop_nulls`` drop, in turn: (column, dropped)."""
    present = _present(df, columns or ("content", "link", "date"))
    if not present:
        return df.sparkSession.createDataFrame([], "column string, dropped bigint")
    kept = F.lit(True)
    sums: list[Column] = []
    for c in present:
        sums.append(F.count_if(kept & F.col(c).isNull()).alias(c))
        kept = kept & F.col(c).isNotNull()
    return df.agg(*sums).unpivot([], present, "column", "dropped")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) != "")


def exclude_channel_like(df: DataFrame, needle: str, channel: str = "channel") -> DataFrame:
    """Drop rows whose channel contains ``needle``, ignoring case; a null channel stays."""
    if channel not in df.columns:
        return df
    return df.where(~F.coalesce(F.lower(channel).contains(needle.lower()), F.lit(False)))


def exclude_channels(df: DataFrame, channels: Iterable[str], channel: str = "channel") -> DataFrame:
    """Drop rows of the listed channels; a null channel stays."""
    listed = sorted(set(channels))
    return df.where(~F.coalesce(F.col(channel).isin(listed), F.lit(False))) if listed else df


def date_range(
    df: DataFrame,
    start: str | datetime.datetime | None = None,
    end: str | datetime.datetime | None = None,
    column: str = "date",
    to_utc: bool = False,
) -> DataFrame:
    """Rows with ``start <= date < end``; either bound may be missing. Null dates fall out.

    Bounds are cast to the column's type as literals, so the filter reaches the file scan.
    """
    df = df if dict(df.dtypes)[column] != "string" else parse_dates(df, column, to_utc)
    kind = dict(df.dtypes)[column]
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.where(F.col(column) < F.lit(end).cast(kind))
    return df


def split_by_length(df: DataFrame, text: str = "content", words: int = 7) -> tuple[DataFrame, DataFrame]:
    """(kept, short): rows with at least and with at most ``words`` words.

    Rows with exactly ``words`` words are in both; both carry ``word_count``.
    """
    counted = df.withColumn("word_count", word_count(text))
    return counted.where(F.col("word_count") >= words), counted.where(F.col("word_count") <= words)


def rename_first(df: DataFrame, name: str) -> DataFrame:
    """Rename the first column by position, for files whose first header field is not its name."""
    return df.withColumnRenamed(df.columns[0], name)
