"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a word budget. Whole epochs of the source are taken first; the rest of the budget is
filled without replacement by documents in the order of exponential keys ``-ln(u) / weight`` (smallest
first), ``u`` being a hash of id and seed. Documents are laid out by (source, key) in range partitions
and written once; sums per partition give each its offset, and a window inside a partition gives the
running sum, so a source with most of the rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.hashing import hash32
from ..session import stage
from .common import count_chars, count_words, text_or_empty

#: fixed values: weights by rank of the source, repeating, and the most epochs of a source
WEIGHTS, MAX_EPOCHS = (5, 2, 1), 3
SYMBOLS = "#*$%&|<>"


def default_quality(text: Column, size: Column) -> Column:
    """Weight in [0.25, 1]: falls with the number of symbol characters per word."""
    return F.greatest(F.lit(0.25), (size + 1) / (size + 1 + 10 * count_chars(text, SYMBOLS)))


def text_digest(text: Column) -> Column:
    return F.substring(F.md5(text_or_empty(text)), 1, 16)


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target from (source, source_size): weighted shares of the sum, none above 3 sizes.

    Sources rank by code point, null last. What a capped source cannot take is shared again by weight
    among the others, until no target is above its cap; each round is one aggregate over the sources.
    """
    spark = sizes.sparkSession
    ranked = sizes.orderBy(F.asc_nulls_last("source")).rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
    share = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = stage(spark.createDataFrame(ranked, "source string, source_size long, rank long")
                   .withColumn("share", share.cast("double")), "mix-sources")
    cap = F.col("source_size") * float(MAX_EPOCHS)
    level, capped = 0.0, -1
    while True:
        over = F.lit(capped >= 0) & (F.col("share") * level > cap)
        x = ranked.agg(F.sum("source_size"), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("share"))),
                       F.sum(over.cast("long"))).first()
        if capped == (x[3] or 0) or not x[2]:
            break
        capped, level = x[3], ((x[0] or 0) - (x[1] or 0.0)) / x[2]
    return ranked.select("source", "source_size", F.least(cap, F.col("share") * level).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0,
        quality=default_quality) -> DataFrame:
    """One row per document: doc_id, size (words), source, source_size, target, copies, taken, and the text digest.

    ``copies`` is how often the mix takes the document whole, ``taken = size * copies``. The document at
    which the running sum crosses the budget is taken if that brings the source nearer to its target,
    so a source is off by at most half of one document. Null texts have size 0. Rows with the same id
    and text have the same key and are ordered arbitrarily among themselves, with equal sizes, so reruns
    agree as a set of rows. Empty tables give no rows. A null quality weighs 0.25.
    """
    size = count_words(F.col(text))
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"),
                        quality(text_or_empty(F.col(text)), size).alias("weight"), text_digest(F.col(text)).alias("digest"))
    u = (hash32(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "digest") + 0.5) / float(1 << 32)
    keyed = plain.withColumn("key", -F.log(u) / F.coalesce("weight", F.lit(0.25)))
    order = ["key", "doc_id", "digest", "size"]
    laid = (keyed.repartitionByRange(F.asc_nulls_last("source"), *[F.asc(c) for c in order])
            .withColumn("part", F.spark_partition_id()))
    laid = stage(laid.select("doc_id", "source", "size", "key", "digest", "part"), "mix-keys")
    parts = laid.groupBy("source", "part").agg(F.sum("size").alias("words"))
    targets = source_targets(parts.groupBy("source").agg(F.sum("words").cast("long").alias("source_size")))
    epochs = F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0)).cast("int")
    before = F.coalesce(F.sum("words").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    plan = (parts.withColumn("before", before)
            .join(targets.withColumn("epochs", epochs).withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
            .select(F.col("source").alias("of"), F.col("part").alias("in_part"), "before", "source_size", "target", "epochs",
                    (F.col("target") - F.col("epochs") * F.col("source_size")).alias("budget")))
    running = F.sum("size").over(W.partitionBy("source", "part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    summed = laid.withColumn("running", running)
    rows = summed.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part")))
    end = F.col("before") + F.col("running")
    start = end - F.col("size")
    chosen = (start < F.col("budget")) & ((end <= F.col("budget")) | (end - F.col("budget") < F.col("budget") - start))
    copies = F.col("epochs") + chosen.cast("int")
    return rows.select("doc_id", "digest", "size", "source", "source_size", "target", copies.alias("copies"),
                       (F.col("size") * copies).alias("taken"))
