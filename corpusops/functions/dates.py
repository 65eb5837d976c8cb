"""Parsing of date strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P


def has_offset(value: Column | str) -> Column:
    """True where a date string carries an offset such as ``+03:00``."""
    return (F.col(value) if isinstance(value, str) else value).rlike(P.UTC_OFFSET)


#: formats beside ISO 8601, tried in this order; pass what the data has as ``formats``
DAY_FIRST = ("d.M.yyyy[ H:mm[:ss]]", "d/M/yyyy[ H:mm[:ss]]", "d MMM yyyy[ H:mm[:ss]]", "d MMMM yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]", "yyyyMMdd")
MONTH_FIRST = ("M/d/yyyy[ H:mm[:ss]]", "MMM d, yyyy[ H:mm[:ss]]", "MMMM d, yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]", "yyyyMMdd")


def wall_clock(value: Column | str, to_utc: bool = False, formats: Sequence[str] = ()) -> Column:
    """Naive timestamp of a date string; what cannot be parsed becomes null.

    ISO 8601 comes first, then ``formats`` in their order. An offset is dropped and the clock time kept. ``to_utc=True`` shifts
    such values to UTC instead.
    """
    value = F.col(value) if isinstance(value, str) else value
    plain = F.regexp_replace(value, f"{P.UTC_OFFSET}$", "")
    # eight digits would be read as a year
    iso = F.when(~plain.rlike(r"^[0-9]{5,}$"), plain.try_cast("timestamp_ntz")) if formats else plain.try_cast("timestamp_ntz")
    naive = F.coalesce(iso, *[F.try_to_timestamp(F.trim(plain), F.lit(f)).cast("timestamp_ntz") for f in formats])
    if not to_utc:
        return naive
    instant = value.try_cast("timestamp").cast("timestamp_ntz")
    shifted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant)
    return F.when(has_offset(value), shifted).otherwise(naive)


def parse_dates(df: DataFrame, column: str = "date", to_utc: bool = False, formats: Sequence[str] = ()) -> DataFrame:
    """Turn a string date column into naive timestamps; no-op if it is missing or no string."""
    kind = dict(df.dtypes).get(column)
    if kind == "string":
        return df.withColumn(column, wall_clock(column, to_utc, formats))
    if kind in ("timestamp", "date"):
        return df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return df


def unparsed_dates(df: DataFrame, column: str = "date", formats: Sequence[str] = ()) -> DataFrame:
    """One row (rows, nulls, unparsed): how many values ``parse_dates`` would turn into nulls."""
    given = F.col(column).isNotNull()
    return df.agg(F.count("*").alias("rows"), F.count_if(~given).alias("nulls"), F.count_if(given & wall_clock(column, formats=formats).isNull()).alias("unparsed"))
