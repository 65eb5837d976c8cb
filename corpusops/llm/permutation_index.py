"""Approximate nearest neighbours with a permutation index.

Every vector is represented by its nearest pivots in order. Pivots are rows of the table, drawn by hash;
their number grows with the square root of the table. The index is cut into blocks of bounded size by
hash; in a block, vectors are posted under their pivots with the rank. A query reads the lists of its own
pivots in every block and ranks the block by the footrule distance of the two orders (a pivot missing from
one order counts as rank ``prefix``); the best are reranked by exact distance, and only the nearest leave
the block. Queries come in blocks of bounded size too, so a task holds one block of each. Equal vectors are
one entry of the index and are expanded again at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage

#: pivots: factor on the square root of the number of distinct vectors, least number; most pivots (a documented
#: sample: 16,384 pivots of 1,024 dimensions are 128 MB); posted pivots per vector
PIVOT_FACTOR, LEAST_PIVOTS, MOST_PIVOTS, PREFIX = 2.0, 512, 16_384, 128
#: reranked per query and block: this part of the block, and no fewer than RERANK
RERANK_PART, RERANK = 0.1, 400
#: entries and queries of a block
BLOCK_ENTRIES, BLOCK_QUERIES = 20_000, 4096


def usable(vector) -> "F.Column":
    """Not null, no null or non-finite component, not all zero, not empty."""
    v = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _orders(pivots, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        half = (p * p).sum(1) / 2
        for batch in batches:
            v = np.asarray(batch["vector"].values).reshape(batch.num_rows, -1)
            ids = []
            for at in range(0, len(v), 512):  # larger is nearer: x . p - |p|^2 / 2
                near = v[at:at + 512] @ p.T - half
                k = min(prefix, len(p))
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                order = np.lexsort((top, -np.take_along_axis(near, top, 1)), axis=1)
                ids.append(np.take_along_axis(top, order, 1).astype(np.int32))
            flat = np.concatenate(ids) if ids else np.zeros((0, 1), np.int32)
            at = pa.array(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1])
            yield pa.RecordBatch.from_arrays([batch["entry"], pa.ListArray.from_arrays(at, pa.array(flat.ravel()))], ["entry", "pivots"])
    return run


def _nearest_in_block(prefix: int, rerank: int, keep: int):
    def run(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if entries.empty or queries.empty:
            return pd.DataFrame({"query_entry": np.zeros(0, np.int64), "entry": np.zeros(0, np.int64)})
        entries = entries.sort_values("entry")
        ids, vectors, orders = entries["entry"].to_numpy(), np.stack(entries["vector"]), np.stack(entries["pivots"])
        posted = np.argsort(orders.ravel(), kind="stable")  # the inverted file: postings by pivot, then by entry
        who, at = np.divmod(posted, orders.shape[1])
        lists = np.searchsorted(orders.ravel()[posted], np.arange(max(orders.max(), np.stack(queries["order"]).max()) + 2))
        best = min(len(ids), max(rerank, int(RERANK_PART * len(ids))))
        found = []
        for query, order in zip(queries["query"], queries["order"]):
            near = np.zeros(len(ids), np.int32)  # the footrule distance is a constant minus twice this
            for own, pivot in enumerate(order):
                s, e = lists[pivot], lists[pivot + 1]
                near[who[s:e]] += prefix - np.maximum(at[s:e], own)
            top = np.argpartition(-near, best - 1)[:best]
            distance = ((vectors[top] - query) ** 2).sum(1)
            found.append(ids[top[np.lexsort((ids[top], distance))[:keep]]])
        return pd.DataFrame({"query_entry": np.repeat(queries["query_entry"].to_numpy(), [len(f) for f in found]), "entry": np.concatenate(found)})
    return run


def search(vectors: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id", vector: str = "embedding",
           prefix: int = PREFIX, rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every row whose id is divisible by ``every``.

    ``score`` is the Euclidean distance in double precision; ties go to the smaller id. Rows with a null
    id or an unusable vector take no part, nor do rows of another dimension than the most common one
    of the table. A row is not its own candidate, and rows repeated whole are one row. Blocks of
    up to ``rerank`` entries are reranked whole, so all candidates are found where there are fewer than ``k``.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("raw"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("raw"))).select(
        "vec_id", F.transform("raw", lambda x: x.cast("double")).alias("vector")).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    widths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("vector") == (widths[0] if widths else 0))
    # an entry is a distinct vector, named by its smallest id; of its rows only the k + 1 smallest ids can be answers
    entries = stage(rows.groupBy("vector").agg(F.min("vec_id").alias("entry")), "index-entries")
    named = rows.join(entries, "vector").select("vec_id", "entry").distinct()
    members = stage(named.withColumn("_rank", F.row_number().over(W.partitionBy("entry").orderBy("vec_id"))).where(F.col("_rank") <= k + 1).drop("_rank"), "index-members")
    queries = stage(named.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query_entry")), "index-queries")

    count = entries.count()
    wanted = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, round(PIVOT_FACTOR * count ** 0.5))))
    drawn = entries.orderBy(F.xxhash64("entry"), "entry").limit(wanted).toPandas()
    if drawn.empty:
        return queries.select("query_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    pivots = spark.sparkContext.broadcast(np.stack(drawn["vector"].to_numpy()).astype(float))
    orders = stage(entries.select("entry", "vector").mapInArrow(_orders(pivots, prefix), "entry long, pivots array<int>"), "index-orders")
    indexed = entries.join(orders, "entry")
    asked = queries.select(F.col("query_entry").alias("of")).distinct()
    parts, turns = -(-count // BLOCK_ENTRIES), max(1, -(-asked.count() // BLOCK_QUERIES))

    def blocks(key: str, n: int):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every_block(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asking = (indexed.join(asked, F.col("entry") == F.col("of"), "left_semi")
              .select(F.col("entry").alias("query_entry"), F.col("vector").alias("query"), F.col("pivots").alias("order"))
              .withColumn("at_turn", blocks("query_entry", turns)).withColumn("at_part", every_block(parts)))
    sides = (indexed.withColumn("part", blocks("entry", parts)).withColumn("turn", every_block(turns)).groupBy("part", "turn")
             .cogroup(asking.groupBy("at_part", "at_turn")))
    # a few more than needed leave a block: the last digits of the distances are summed in another order below
    best = stage(sides.applyInPandas(_nearest_in_block(prefix, rerank, k + 8), "query_entry long, entry long"), "index-candidates")
    q = entries.select(F.col("entry").alias("query_entry"), F.col("vector").alias("q"))
    squares = F.aggregate(F.zip_with("q", "vector", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    scored = best.join(entries, "entry").join(q, "query_entry").select("query_entry", "entry", F.sqrt(squares).alias("score"))
    near = scored.withColumn("_rank", F.rank().over(W.partitionBy("query_entry").orderBy("score", "entry"))).where(F.col("_rank") <= k + 1).drop("_rank")
    found = (near.join(members, "entry").join(queries, "query_entry").where("query_id <> vec_id")
             .withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k))
    return found.select("query_id", "rank", "vec_id", "score")
