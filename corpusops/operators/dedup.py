"""Duplicate removal and last-wins lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_best(df: DataFrame, key: str | list[str], order: str, label: str = "true_label") -> DataFrame:
    """One row per key: label 1 beats any other label, then the last row by ``order`` wins.

    Null keys compare equal and a null label counts as "other". The rank filter is applied before
    the shuffle too (WindowGroupLimit), so a key that holds a third of the table sends one row per
    map task.
    """
    keys = [key] if isinstance(key, str) else key
    positive = F.coalesce(F.col(label) == 1, F.lit(False))
    best_first = Window.partitionBy(*keys).orderBy(positive.desc(), F.col(order).desc())
    return df.withColumn("__rank", F.row_number().over(best_first)).where("__rank = 1").drop("__rank")


def drop_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the keys of ``known``; null keys compare equal."""
    keys = known.select(F.col(key).alias("__known")).distinct()
    return df.join(keys, F.col(key).eqNullSafe(F.col("__known")), "left_anti")


def lookup_last(left: DataFrame, right: DataFrame, key: str, value: str, order: str, output: str | None = None) -> DataFrame:
    """Add ``right``'s value for the key, the last one by ``order``; null if there is none."""
    last = right.groupBy(key).agg(F.max_by(value, order).alias(output or value))
    return left.join(last, key, "left")


def distinct_in_order(items: Column | str) -> Column:
    """Distinct array members in order of first occurrence."""
    return F.array_distinct(F.col(items) if isinstance(items, str) else items)
