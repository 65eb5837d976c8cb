"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_stages, stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the smallest one: those above the node (large) or the node and those below it (small)."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))) if large else \
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("of", "m").alias("m"))
    near = both.join(least, F.col("a") == F.col("of"))
    if large:
        out = near.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("of").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node that links reach.

    Rounds of large and small stars; each is written before the next, so a lost executor repeats one
    round only. Neighbours are never gathered: minima are aggregates that combine before the shuffle.
    Self links are ignored, repeated links count once, an empty table gives no rows.
    """
    state = None
    staged = stage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    links = staged.select(F.col("b").alias("a"), F.col("a").alias("b"))
    while True:
        before, links = staged, stage(_star(_star(links, True), False), "stars")
        drop_stages(before)
        staged = links
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
