"""Sharding by vector bin packing: bytes, tokens and rows of groups of equal texts are balanced together.

A group goes to the shard whose residual capacity has the highest dot product with the group's vector
(all as shares of the total). Groups that hold more than ``1 / LARGE`` of any total are placed first:
at most ``3 * LARGE`` exist, so that list is bounded whatever the input and is packed on the driver;
one of more than half a shard is split. All other groups are dealt by hash to lots of
bounded size, and each lot is packed on its own against its share of the capacity that is left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .common import count_words

#: a group above this part of a total is placed first; groups of a lot; hash ranges that number the slots of a shard
LARGE, LOT_GROUPS, SLOT_RANGES = 2048, 50_000, 256
#: a group above half a shard is split into pieces of an eighth of a shard
SPLIT_ABOVE, PIECE = 0.5, 0.125
#: how much bytes, tokens and rows count in the dot product
WEIGHTS = np.array([4.0, 1.0, 1.0])
ROW_OVERHEAD = 16


def pack(vectors: np.ndarray, residual: np.ndarray, first: int = 0) -> np.ndarray:
    """Shard of each vector (in the given order); ``residual`` [shards, 3] is used up in place.

    Ties go to the first shard counted from ``first``.
    """
    out, shards = np.empty(len(vectors), np.int32), len(residual)
    turn = np.roll(np.arange(shards), -(first % shards))
    for i, v in enumerate(vectors):
        s = turn[int(np.argmax(residual[turn] @ (WEIGHTS * v)))]
        residual[s] -= v
        out[i] = s
    return out


def shard(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes + 16), tokens (words), text_crc32, shard, slot.

    Slots are numbered from 0 without gaps in each shard. Groups are equal texts, null being one of them
    (no bytes, crc32 null). A group stays in one shard unless it holds more than half a shard; then its rows are dealt by number,
    whatever their ids. Reruns over the same files agree;
    of rows with the same id and text it is open which takes which slot. Further columns are not read. Empty tables give no rows.
    """
    t = F.col(text).cast("string")
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(t), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
                       count_words(t).alias("tokens"), F.crc32(t.cast("binary")).alias("text_crc32"),
                       F.coalesce(F.md5(t), F.lit("null")).alias("group"), F.monotonically_increasing_id().alias("place"))
    rows = stage(rows, "shard-rows")
    groups = stage(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "shard-groups")
    sums = groups.agg(F.sum("bytes"), F.sum("tokens"), F.sum("rows"), F.count(F.lit(1))).first()
    total = np.array([float(x or 0) or 1.0 for x in sums[:3]])
    lots = max(1, -(-(sums[3] or 0) // LOT_GROUPS))

    share = F.greatest(F.col("bytes") / F.lit(total[0]), F.col("tokens") / F.lit(total[1]), F.col("rows") / F.lit(total[2]))
    large = groups.where(share > 1 / LARGE).select(F.col("group").alias("of"), F.when(
        share > SPLIT_ABOVE / shards, F.ceil(share * (shards / PIECE))).otherwise(1).cast("int").alias("pieces"))
    large = F.broadcast(stage(large, "shard-large"))  # at most 3 * LARGE rows
    columns = ["doc_id", "size", "tokens", "text_crc32", "group", "place"]
    marked = rows.join(large, F.col("group") == F.col("of"), "left").select(*columns, "pieces")
    # rows of a large group are dealt by number, as ids may be missing or repeated
    dealt = number_slots(marked.where("pieces > 1"), "group", "place", ["place"]).withColumn("piece", F.pmod("slot", "pieces").cast("int"))
    cut = stage(dealt.select(*columns, "piece", F.lit(True).alias("large")).union(
        marked.where("pieces IS NULL OR pieces = 1").select(*columns, F.lit(0), F.col("pieces").isNotNull())), "shard-rows-cut")
    pieces = (cut.where("large").groupBy("group", "piece").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
              .toPandas().sort_values(["bytes", "group", "piece"], ascending=[False, True, True]))  # at most 3 * (LARGE + 2 * shards / PIECE) rows
    residual = np.full((shards, 3), 1.0 / shards)
    placed = pack(pieces[["bytes", "tokens", "rows"]].to_numpy(float) / total, residual)
    left = np.maximum(residual, 0)
    left = left / np.maximum(left.sum(0), 1e-300)

    def pack_lot(key: tuple, lot: pd.DataFrame) -> pd.DataFrame:
        lot = lot.sort_values(["bytes", "group"], ascending=[False, True])
        vectors = lot[["bytes", "tokens", "rows"]].to_numpy(float) / total
        return pd.DataFrame({"group": lot["group"], "shard": pack(vectors, left * vectors.sum(0), int(key[0]))})

    spark = docs.sparkSession
    small = (groups.where(~(share > 1 / LARGE)).withColumn("lot", F.pmod(F.xxhash64("group"), F.lit(lots)))
             .groupBy("lot").applyInPandas(pack_lot, "group string, shard int"))
    small = stage(small.select(F.col("group").alias("of"), F.col("shard").alias("to")), "shard-placed")
    big = spark.createDataFrame(pd.DataFrame({"of": pieces["group"].astype(str), "in_piece": pieces["piece"].astype("int32"), "to": placed}),
                                "of string, in_piece int, to int")
    out = (cut.where("large").join(F.broadcast(big), (F.col("group") == F.col("of")) & (F.col("piece") == F.col("in_piece")))
           .select(*columns, F.col("to").alias("shard"))
           .union(cut.where(~F.col("large")).join(small, F.col("group") == F.col("of"))
                  .select(*columns, F.col("to").alias("shard"))))
    return number_slots(stage(out, "shard-rows-placed"), "shard", "place", ["doc_id", "group", "place"]).select(
        "doc_id", "size", "tokens", "text_crc32", "shard", "slot")


def number_slots(rows: DataFrame, key: str, spread: str, order: list[str]) -> DataFrame:
    """Add ``slot``: 0, 1, ... within each ``key``, without sorting a whole key in one task.

    Rows fall into hash ranges; counts of the ranges give each its offset.
    """
    ranged = rows.withColumn("_range", F.pmod(F.xxhash64(spread), F.lit(SLOT_RANGES)))
    sizes = ranged.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("_key").orderBy("_of").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_key", "_of", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(W.partitionBy(key, "_range").orderBy(*order))
    return (ranged.withColumn("_own", own).join(offsets, (F.col(key) == F.col("_key")) & (F.col("_range") == F.col("_of")))
            .withColumn("slot", (F.col("_before") + F.col("_own") - 1).cast("long")).drop("_range", "_key", "_of", "_before", "_own"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, doc_id: str = "doc_id") -> str:
    """Write the documents as Parquet, one folder per shard, in the order of ids inside a file; ids must be unique."""
    target = placed.select(F.col("doc_id").alias("_id"), "shard", "slot")
    (docs.join(target, F.col(doc_id) == F.col("_id")).drop("_id").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
    return path
