"""Rule classification of a news file, its metrics and its output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_dates
from ..operators import frames
from ..operators.metrics import evaluate
from ..operators.rules import classify
from ..sources.readers import read_news
from ..sources.sinks import append_metrics, save_classification
from ..session import stage


def prepare_labelled(
    data: DataFrame, text: str = "content", date: str = "date", channel: str = "channel", exclude_like: str | None = None
) -> DataFrame:
    if exclude_like:
        data = frames.exclude_channel_like(data, exclude_like, channel)
    frames.require(data, text, date)
    return frames.drop_nulls(parse_dates(data, date), text, date)


def classify_frame(
    data: DataFrame,
    rules: Sequence[str],
    df_name: str,
    text: str = "content",
    date: str = "date",
    channel: str = "channel",
    label_type: str = "positive",
    exclude_like: str | None = None,
    filtered: bool = False,
    start: str | None = None,
    end: str | None = None,
    invert_negative: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(classified rows, metrics); both lazy."""
    data = prepare_labelled(data, text, date, channel, exclude_like)
    if filtered:
        data, _ = frames.split_by_length(frames.date_range(data, start, end, date), text, 7)
    classified = classify(data, rules, text, label_type, invert_negative)
    metrics = evaluate(classified, [], score=None).select(F.lit(df_name).alias("df_name"), "*")
    return classified, metrics


def run_classification(
    spark: SparkSession,
    path: str,
    rules: Sequence[str],
    output_folder: str,
    metrics_path: str,
    df_name: str = "news_data",
    **options,
) -> tuple[str, DataFrame]:
    """Classify a file, append its metrics and write the rows; returns (path, metrics).

    The classified rows are written first and the metrics read that table back, so the patterns
    run once. Comma-separated gzip and semicolon-separated plain files are read alike.
    """
    classified, _ = classify_frame(read_news(spark, path, gz_sep=","), rules, df_name, **options)
    rows = stage(classified, "classified")
    metrics = evaluate(rows, [], score=None).select(F.lit(df_name).alias("df_name"), "*")
    append_metrics(metrics, metrics_path)
    return save_classification(rows, output_folder, df_name, options.get("filtered", False)), metrics
