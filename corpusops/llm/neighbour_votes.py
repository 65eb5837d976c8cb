"""Quality classifier: votes of the nearest labelled documents in a latent-semantic space.

A text becomes two blocks of term weights: words hashed to WORD_DIMS numbers with idf over all
documents, and shapes of words (case, marks, repetition, length). Each block has length 1. A truncated SVD of the
labelled sample gives LATENT directions; the sample's latent vectors are broadcast (MAX_LABELLED x
LATENT floats at most), and every document is multiplied with all of them, in blocks. The labels of the
NEIGHBOURS most similar ones are weighted by a power of the cosine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold
from .tokens import text_buffers, word_hashes

WORD_DIMS, SHAPE_DIMS, LATENT, NEIGHBOURS, POWER = 4096, 512, 64, 15, 4.0
#: documented bound of the labelled sample: it is drawn by hash from all labelled rows of the training folds
MAX_LABELLED = 8192
DIMS, GROUP = WORD_DIMS + SHAPE_DIMS, 256
#: rows of the labelled sample that the driver holds dense at a time, 18 KB each
BLOCK = 512

_IS = {name: np.zeros(256, bool) for name in ("upper", "lower", "digit", "stop", "mark")}
_IS["upper"][65:91] = True
_IS["lower"][97:123] = True
_IS["lower"][128:] = True
_IS["digit"][48:58] = True
_IS["stop"][[44, 46, 59, 58, 39, 34, 40, 41, 63, 45]] = True
_IS["mark"] = ~(_IS["upper"] | _IS["lower"] | _IS["digit"] | _IS["stop"])
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def _shapes(data: np.ndarray, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A number below SHAPE_DIMS for each word of ``data``, whose texts hold words ``bounds``."""
    is_word = ~_SPACE[data]
    text_start = np.zeros(len(data) + 1, bool)
    text_start[bounds[(bounds >= 0) & (bounds <= len(data))]] = True
    edge = np.flatnonzero(is_word & (np.concatenate([[True], ~is_word[:-1]]) | text_start[:-1]))
    ends = np.flatnonzero(is_word & (np.concatenate([~is_word[1:], [True]]) | text_start[1:])) + 1
    count = {}
    for name, table in _IS.items():
        total = np.concatenate([[0], np.cumsum(table[data])])
        count[name] = total[ends] - total[edge]
    length = ends - edge
    letters = count["upper"] + count["lower"]
    case = np.where(letters == 0, 0, np.where(count["upper"] == 0, 1, np.where((count["upper"] == letters) & (letters > 1), 3, 2)))
    size = np.digitize(length, [2, 4, 8, 16])
    same = np.zeros(len(hashes), np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    marks = np.minimum(count["mark"], 3)
    code = case + 4 * (marks + 4 * ((count["stop"] > 0) + 2 * ((count["digit"] > 0) + 2 * same)))
    return (code * 5 + size) % SHAPE_DIMS


def counts(column: pa.Array) -> Iterator[np.ndarray]:
    """Term counts (texts x DIMS) for consecutive groups of at most GROUP texts."""
    offsets, data = text_buffers(column)
    for first, hashes, bounds in word_hashes(column):
        n = len(bounds) - 1
        if n == 1 and offsets[first + 1] - offsets[first] > (1 << 22):  # a giant text: shapes in pieces that end at white space
            shapes = _giant_shapes(data[offsets[first]:offsets[first + 1]], hashes)
        else:
            block = data[offsets[first]:offsets[first + n]]
            shapes = _shapes(block, hashes, offsets[first:first + n + 1] - offsets[first]) if len(block) else np.zeros(0, np.int64)
        words = (hashes % np.uint64(WORD_DIMS)).astype(np.int64)
        for at in range(0, n, GROUP):
            to = min(at + GROUP, n)
            s, e = bounds[at], bounds[to]
            row = np.repeat(np.arange(to - at), np.diff(bounds[at:to + 1])) * DIMS
            both = np.concatenate([row + words[s:e], row + WORD_DIMS + shapes[s:e]])
            yield np.bincount(both, minlength=(to - at) * DIMS).reshape(to - at, DIMS)


def _giant_shapes(data: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out, at, seen = [], 0, 0
    while at < len(data):
        to = min(at + (1 << 22), len(data))
        while to < len(data) and not _SPACE[data[to]]:
            to += 1
        words = int(np.count_nonzero(~_SPACE[data[at:to]] & np.concatenate([[True], _SPACE[data[at:to - 1]]])))
        out.append(_shapes(data[at:to], hashes[seen:seen + words], np.array([0])))
        at, seen = to, seen + words
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def weights(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Both blocks at length 1 (or 0 without words): log counts with idf, and roots of shape shares."""
    out = np.empty(count.shape, np.float32)
    out[:, :WORD_DIMS] = np.log1p(count[:, :WORD_DIMS]) * idf
    out[:, WORD_DIMS:] = np.sqrt(count[:, WORD_DIMS:])
    for block in (out[:, :WORD_DIMS], out[:, WORD_DIMS:]):
        block /= np.maximum(np.sqrt((block * block).sum(1, keepdims=True)), 1e-12)
    return out


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs, seen = 0, np.zeros(WORD_DIMS, np.int64)
    for batch in batches:
        docs += batch.num_rows
        for count in counts(batch["text"]):
            seen += (count[:, :WORD_DIMS] > 0).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, WORD_DIMS)), pa.array(np.concatenate([[docs], seen]))], ["term", "n"])


def _features(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [w[i] for c in counts(batch["text"]) for w in [weights(c, idf.value)] for i in range(len(w))]
            used = [np.flatnonzero(r) for r in rows]
            yield pa.RecordBatch.from_arrays([batch["label"], pa.array([u.astype(np.int32) for u in used], pa.list_(pa.int32())),
                                              pa.array([r[u] for r, u in zip(rows, used)], pa.list_(pa.float32()))], ["label", "at", "value"])
    return run


def dense_blocks(at: pa.ListArray, value: pa.ListArray, order: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of weights in the given order, dense (rows x DIMS), at most BLOCK at a time, from the dimensions that each uses."""
    starts, where, what = at.offsets.to_numpy(), at.values.to_numpy(), value.values.to_numpy()
    for first in range(0, len(order), BLOCK):
        own = order[first:first + BLOCK]
        x = np.zeros((len(own), DIMS), np.float32)
        for place, i in enumerate(own.tolist()):
            x[place, where[starts[i]:starts[i + 1]]] = what[starts[i]:starts[i + 1]]
        yield x


def latent_directions(blocks: Callable[[], Iterator[np.ndarray]], rows: int, k: int = LATENT, rounds: int = 4) -> np.ndarray:
    """The first right singular directions of the ``rows`` that ``blocks`` gives, by subspace iteration from a fixed start."""
    k = min(k, rows, DIMS)
    q = np.linalg.qr(np.random.default_rng(7).standard_normal((DIMS, k)).astype(np.float32))[0]
    for _ in range(rounds):
        q = np.linalg.qr(sum(x.T @ (x @ q) for x in blocks()))[0]
    return q


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def vote(latent: np.ndarray, labelled: np.ndarray, labels: np.ndarray, prior: float) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighted by cosine to a power; ``prior`` without any."""
    if not len(labelled):
        return np.full(len(latent), prior)
    cosine = latent @ labelled.T
    k = min(NEIGHBOURS, len(labelled))
    top = np.sort(np.argpartition(-cosine, k - 1, axis=1)[:, :k], axis=1)
    w = np.maximum(np.take_along_axis(cosine, top, 1), 0).astype(float) ** POWER
    return ((w * labels[top]).sum(1) + 1e-3 * prior) / (w.sum(1) + 1e-3)


def _score(model, inner: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, directions, labelled, labels, prior = model.value
        for batch in batches:
            text = batch["row"].field(inner) if inner else batch["text"]
            out = [vote(_unit(weights(c, idf) @ directions), labelled, labels, prior) for c in counts(text)]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(np.concatenate(out) if out else np.zeros(0))], ["row", "score"])
    return run


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None,
             folds: int = 3, held_fold: int = 1, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per document: a struct ``row`` of the columns in ``carry`` (default: the id), held_out, score, predicted.

    ``held_out``: crc32 of the id modulo ``folds`` is ``held_fold`` (false for a null id); labels
    (doc_id, quality) of such rows are never read. A document with several labels has the smallest, null
    labels do not count; of several rows with one id that with the smallest digest of its text is labelled. At most
    ``max_labelled`` labelled documents, chosen by the hash of the id, are learned from. Neighbours at equal distance count in the order of the sample. The score (0 to 1) depends on the text alone; a null or empty text, and every
    text if there are no labels, scores the share of label 1 in the sample (1/2 without labels).
    """
    spark = docs.sparkSession
    carry = carry or [doc_id]
    held = F.coalesce(fold(doc_id, folds) == held_fold, F.lit(False))
    texts = docs.select(F.col(text).cast("string").alias("text"))
    found = texts.mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # WORD_DIMS + 1 rows
    seen = np.zeros(WORD_DIMS + 1)
    seen[found["term"].to_numpy() + 1] = found["n"].to_numpy()
    idf = np.log((1 + seen[0]) / (1 + seen[1:])).astype(np.float32) + np.float32(1)
    shared = spark.sparkContext.broadcast(idf)

    known = (labels.select(F.col("doc_id").alias("of"), F.col("quality").cast("int").alias("label")).where("label IS NOT NULL")
             .where(~F.coalesce(fold("of", folds) == held_fold, F.lit(False))).groupBy("of").agg(F.min("label").alias("label")))
    # only labels of documents that are there count, and of the rows of an id that with the smallest digest
    given = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).withColumn("digest", F.xxhash64("text"))
    known = (given.select("id", "digest").join(known, F.col("id") == F.col("of")).groupBy("of").agg(F.min("digest").alias("first"), F.min("label").alias("label"))
             .orderBy(F.xxhash64("of"), "of").limit(max_labelled))
    sample = (given.join(F.broadcast(known), (F.col("id") == F.col("of")) & (F.col("digest") == F.col("first"))).dropDuplicates(["of"])
              .select("label", "text").mapInArrow(_features(shared), "label int, at array<int>, value array<float>").toArrow())
    y = sample["label"].to_numpy().astype(float)
    at, value = sample["at"].combine_chunks(), sample["value"].combine_chunks()
    some = np.zeros((len(y), -(-DIMS // 97)), np.float32)  # every 97th dimension, for an order that does not depend on the tasks
    used = at.values.to_numpy()
    among = np.flatnonzero(used % 97 == 0)
    some[np.searchsorted(at.offsets.to_numpy(), among, "right") - 1, used[among] // 97] = value.values.to_numpy()[among]
    order = np.lexsort((*some.T, y))
    y = y[order]
    blocks = partial(dense_blocks, at, value, order)  # the sample is never dense as a whole
    directions = latent_directions(blocks, len(y)) if len(y) else np.zeros((DIMS, 1), np.float32)
    latent = np.concatenate([x @ directions for x in blocks()]) if len(y) else np.zeros((0, 1), np.float32)
    model = spark.sparkContext.broadcast((idf, directions, _unit(latent).astype(np.float32), (y > 0).astype(float),
                                          float((y > 0).mean()) if len(y) else 0.5))
    whole = text in carry
    inner = "text" + "_" * max(map(len, carry))  # a name that no carried column has
    row = F.struct(*[F.col(c).alias(inner) if c == text else F.col(c) for c in carry]).alias("row")
    rows = docs.select(row) if whole else docs.select(row, F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(_score(model, inner if whole else None), schema)
    out = F.struct(*[F.col(f"row.{inner}").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in carry])
    scored = scored.select(out.alias("row"), "score")
    kept_id = F.col(f"row.`{doc_id}`") if doc_id in carry else F.lit(None)
    return scored.select("row", F.coalesce(F.pmod(F.crc32(kept_id.cast("string").cast("binary")), F.lit(folds)) == held_fold, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
