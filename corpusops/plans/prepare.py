"""From a news file or folder to a table ready for text processing."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import parse_dates
from ..operators import frames
from ..sources.readers import latest_file, read_news


def prepare_frame(
    data: DataFrame,
    content: str = "summary",
    date: str = "date",
    link: str = "link",
    channel: str = "channel",
    exclude_like: str | None = None,
    filtered: bool = False,
    start: str | None = None,
    end: str | None = None,
    min_words: int = 7,
) -> DataFrame:
    """Standard names, null rows out, channel and dates filled in.

    ``exclude_like`` drops channels that contain it (for training). ``filtered`` adds the date
    range and the length filter.
    """
    data = frames.adopt_single_column(data)
    data = frames.standard_names(data, content, date, link)
    data = frames.drop_nulls(data, "content", "link", "date")
    if "link" in data.columns:
        data = frames.with_channel(data, "link")
    data = parse_dates(data, "date")
    if exclude_like and channel in data.columns:
        data = frames.exclude_channel_like(data, exclude_like, channel)
    if filtered:
        data = frames.date_range(data, start, end, "date")
        data, _ = frames.split_by_length(data, "content", min_words)
    return data


def is_folder(spark: SparkSession, path: str) -> bool:
    """True for a folder that is no part-file dataset (which itself carries a file suffix)."""
    return not path.rstrip("/").endswith((".gz", ".zip", ".xz", ".csv")) and os.path.splitext(path)[1] == ""


def prepare_news(spark: SparkSession, path: str, **options) -> DataFrame:
    """Read a file, or the newest one of a folder, and prepare it (see ``prepare_frame``)."""
    if is_folder(spark, path):
        newest = latest_file(spark, path)
        if newest is None:
            raise ValueError(f"no suitable file in {path}")
        path = newest
    return prepare_frame(read_news(spark, path), **options)
