"""Documents linked by the Jaccard similarity of their word shingles: an exact self-join.

1. One pass over the texts gives each its set size and set digest (equal sets are one node from here
   on) and counts shingles in a table of fixed size, which only sets the order below.
2. A second pass orders every set from rare to common shingles and posts its first
   ``n - ceil(t * n) + 1``: two sets that reach the threshold ``t`` share one of them. Posts are laid out
   in tiles of (shingle, size band); a band spans a ratio above ``1 / t``, so a partner is in the same
   band or a neighbouring one. Tiles with one node are dropped. A pair is tried where the places of the shared shingle leave
   room for the overlap it needs, as if no earlier one were shared: so it is tried at its first shared shingle, and seldom at others.
3. A parity bitmap per node bounds the overlap from above: sets differ at least in as many elements as
   their bitmaps differ in bits. Pairs that pass are verified by intersecting the sorted arrays.
4. In a few rounds nodes are held against one node of their tiles, later against members of the components found so far, and
   linked nodes are contracted; groups of near copies collapse here without their pairs being listed. Then all pairs of a tile that are not yet in one component are tried, so no link between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_stages, stage
from .common import small_batches
from .components import components
from .tokens import mix, shingle_sets

#: cells of the counting table (a megabyte; it orders shingles and decides nothing), bits of a bitmap
CELLS, BITS = 1 << 18, 512
#: up to so many ids (about 20 MB) the texts to verify are picked by a broadcast join, beyond by a shuffle join
BROADCAST_IDS = 1_000_000
WORDS64 = BITS // 64
#: rounds of contraction at most; what they leave is tried pair by pair
ROUNDS = 4


def text_digest(text: Column) -> Column:
    return F.xxhash64(text)


def digest(shingles: np.ndarray) -> int:
    """64-bit number of a set, from its sorted hashes."""
    if not len(shingles):
        return 0
    place = np.arange(1, len(shingles) + 1, dtype=np.uint64)
    return int(mix(np.array([np.sum(mix(shingles + place * np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)]))[0].view(np.int64))


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Parity of the elements that fall on each bit, as signed 64-bit words."""
    odd = (np.bincount((shingles >> np.uint64(20)).astype(np.int64) % BITS, minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _measure(width: int, extra: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            sizes, nodes = [], []
            for s in shingle_sets(batch["text"], width):
                sizes.append(len(s))
                nodes.append(digest(s))
                cells += np.bincount((s & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS) if len(s) > CELLS // 8 else 0
                if len(s) <= CELLS // 8:
                    np.add.at(cells, (s & np.uint64(CELLS - 1)).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays([pa.array([None] * len(sizes), pa.int64()), batch["doc_id"].cast(pa.int64()),
                                              pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), *[batch[c] for c in extra]], ["cell", "doc_id", "node", "n", *extra])
        used = np.flatnonzero(cells)
        for at in range(0, len(used), 1 << 16):
            part = used[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.int64()), pa.array(cells[part]),
                                              *[pa.nulls(len(part), pa.int64()) for _ in extra]], ["cell", "doc_id", "node", "n", *extra])
    return run


def _post(width: int, percent: int, counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = counts.value
        for batch in batches:
            nodes, sizes, posts, maps = [], [], [], []
            for s in shingle_sets(batch["text"], width):
                keep = prefix_length(len(s), percent) if len(s) else 0
                first = np.lexsort((s, order[(s & np.uint64(CELLS - 1)).astype(np.int64)]))[:keep]
                nodes.append(digest(s))
                sizes.append(len(s))
                posts.append(s[first].view(np.int64))
                maps.append(bitmap(s))
            at = np.concatenate([[0], np.cumsum([len(x) for x in posts])]).astype(np.int32)
            flat = np.concatenate(posts) if posts else np.zeros(0, np.int64)
            bits = np.concatenate(maps) if maps else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"].cast(pa.int64()), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(maps) + 1, dtype=np.int32) * WORDS64), pa.array(bits))],
                ["doc_id", "node", "n", "posts", "bits"])
    return run


def _arrays(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch["text"], width))
            at = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([digest(s) for s in sets], pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], ["node", "shingles"])
    return run


def _verify(percent: int):
    """Keep pairs whose sorted arrays overlap enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            (xa, x), (ya, y) = [(c.offsets.to_numpy(), c.values.to_numpy().view(np.uint64)) for c in (batch["x"], batch["y"])]
            for i in range(batch.num_rows):
                p, q = x[xa[i]:xa[i + 1]], y[ya[i]:ya[i + 1]]
                p, q = (p, q) if len(p) <= len(q) else (q, p)
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int(np.count_nonzero(q[at] == p))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _needed(n1: Column, n2: Column, percent: int) -> Column:
    """Least overlap of two sets that link, times (100 + percent)."""
    return percent * (n1 + n2)


def _room(n1: Column, at1: Column, n2: Column, at2: Column, percent: int) -> Column:
    """Sizes and places of a shared shingle that leave room for the overlap, if none before it is shared."""
    sizes = (100 * F.least(n1, n2)) >= (percent * F.greatest(n1, n2))
    return sizes & ((100 + percent) * F.least(n1 - at1, n2 - at2) >= _needed(n1, n2, percent))


def _differing_bits(x: Column, y: Column) -> Column:
    out = F.lit(0)
    for i in range(WORDS64):
        out = out + F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))))
    return out


def _may_link(n1: Column, bits1: Column, n2: Column, bits2: Column, percent: int) -> Column:
    """Size filter, then the overlap bound (n1 + n2 - differing bits) / 2 held against the threshold."""
    enough = (100 * F.least(n1, n2)) >= (percent * F.greatest(n1, n2))
    overlap = (n1 + n2 - _differing_bits(bits1, bits2))  # twice the bound
    return enough & (100 * overlap >= percent * (2 * (n1 + n2) - overlap))


def linked_components(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
                      nodes: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id that links reach), class_id (equal sets).

    Words are split at ASCII white space after lower-casing A-Z. Two documents link if the Jaccard
    similarity of their shingle sets is at least ``percent`` / 100. Null texts and texts without a word
    have an empty set and stand alone; rows with the same id and text are one document and both returned.
    Rows with a null id get a null component unless linked to an id; they link others like any row. Texts
    of any length are used whole. ``nodes`` adds what tells rows apart without ids: digest (``text_digest``
    of the text) and component (a number of the component; null for an empty set).
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    extra = ["digest"] if nodes else []
    digested = plain.withColumn("digest", text_digest(F.col("text"))) if nodes else plain
    with small_batches(spark):
        measured = stage(digested.mapInArrow(_measure(width, extra), ", ".join(f"{c} long" for c in ["cell", "doc_id", "node", "n", *extra])), "shingle-sizes")
    rows = measured.where("cell IS NULL").drop("cell")
    counts = np.zeros(CELLS, np.int64)
    for r in measured.where("cell IS NOT NULL").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():  # at most CELLS rows
        counts[r[0]] = r[1]
    order = spark.sparkContext.broadcast(counts)

    classes = stage(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("class_id")), "shingle-classes")
    first = classes.select(F.col("node").alias("rep_node"), F.col("class_id").alias("rep_id"))

    def representatives(frame: DataFrame) -> DataFrame:
        return frame.join(first, (F.col("node") == F.col("rep_node")) & F.col("doc_id").eqNullSafe(F.col("rep_id")), "left_semi")

    posted = representatives(plain.mapInArrow(
        _post(width, percent, order), "doc_id long, node long, n long, posts array<long>, bits array<long>").where("n > 0"))
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent * 1.003))).cast("int")
    with small_batches(spark):
        posted = stage(posted.select("node", "n", "bits", band.alias("band"), "posts"), "shingle-posts")
    flat = posted.select("node", "n", "band", F.posexplode("posts").alias("at", "shingle"))
    # most shingles are posted once: counting them alone moves one number each, and only the others get tiles
    often = flat.groupBy(F.col("shingle").alias("s")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("s")
    # a larger partner needs room for more than the set's own size in shares of it: only early shingles reach the next band
    early = (100 + percent) * (F.col("n") - F.col("at")) >= _needed(F.col("n"), F.col("n"), percent)
    places = F.array_compact(F.array(F.col("band"), F.when(early, F.col("band") + 1)))
    flat = stage(flat.join(often, F.col("shingle") == F.col("s"), "left_semi")
                 .select("node", "n", "band", "at", "shingle", F.explode(places).alias("tile")), "shingle-shared")
    shared = (flat.groupBy("shingle", "tile").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most")
              .select(F.col("shingle").alias("s"), F.col("tile").alias("t")))
    tiles = stage(flat.join(shared, (F.col("shingle") == F.col("s")) & (F.col("tile") == F.col("t")), "left_semi")
                  .select("node", "n", "band", "at", "shingle", "tile"), "shingle-tiles")
    drop_stages(flat)
    bits = stage(posted.select("node", "n", "bits").dropDuplicates(["node"]), "shingle-bits")
    drop_stages(posted)

    def side(name: str) -> DataFrame:
        return bits.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))

    def verified(pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Links among candidate pairs (a, b) that passed the bitmaps, and the pairs; only their texts are made into arrays again."""
        pairs = stage(pairs, f"{name}-pairs")
        wanted = pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct()
        wanted = stage(wanted.join(classes, F.col("w") == F.col("node")).select("w", F.col("class_id").alias("id")), f"{name}-wanted")
        ids = wanted.select("id").distinct()
        few = wanted.count() <= BROADCAST_IDS  # else the join moves the texts by id
        # an id may be null or stand for several texts, so the node decides which arrays stay
        arrays = plain.join(F.broadcast(ids) if few else ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").mapInArrow(_arrays(width), "node long, shingles array<long>")
        arrays = arrays.join(wanted.select("w"), F.col("node") == F.col("w"), "left_semi")
        with small_batches(spark):
            arrays = stage(arrays.dropDuplicates(["node"]), f"{name}-arrays")
        x = arrays.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        y = arrays.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        with small_batches(spark):
            links = stage(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long"), f"{name}-links")
        drop_stages(wanted, arrays)
        return links, pairs

    same_tile = (F.col("shingle") == F.col("s")) & (F.col("tile") == F.col("t"))

    def rooted(roots: DataFrame | None) -> DataFrame:
        """Tiles with the component of each node so far."""
        if roots is None:
            return tiles.withColumn("root", F.col("node"))
        return (tiles.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
                .select("node", "n", "band", "at", "shingle", "tile", F.coalesce("root", "node").alias("root")))

    def held_against(named: DataFrame, turn: int) -> DataFrame:
        """(node, low): pairs to try, with room for the overlap, of a node and one of another component in a tile.

        At first each node meets the one that is lowest in most of its tiles; later, in the tiles where a component has several nodes,
        the others meet one of them, another one each turn.
        """
        if turn == 0:
            lowest = F.min(F.struct("root", "node", "n", "at")).alias("low")
            lows = named.groupBy("shingle", "tile").agg(lowest, F.max("root").alias("hi")).where("low.root <> hi")
        else:
            member = F.min(F.struct(F.xxhash64("node", "shingle", F.lit(turn)).alias("by"), "node", "n", "at")).alias("member")
            parts = named.groupBy("shingle", "tile", "root").agg(F.count(F.lit(1)).alias("size"), member)
            most = F.max(F.struct("size", (-F.col("root")).alias("order"), "root", "member.node", "member.n", "member.at")).alias("low")
            lows = parts.groupBy("shingle", "tile").agg(most, F.count(F.lit(1)).alias("parts")).where("parts > 1 AND low.size > 1")
        low = F.col("low")
        met = named.join(lows.select(F.col("shingle").alias("s"), F.col("tile").alias("t"), "low"), same_tile)
        met = met.where((F.col("root") != low["root"]) & _room(F.col("n"), F.col("at"), low["n"], low["at"], percent))
        counted = met.groupBy("node", low["node"].alias("low")).agg(F.count(F.lit(1)).alias("tiles"))
        if turn == 0:
            counted = counted.groupBy("node").agg(F.max(F.struct("tiles", "low"))["low"].alias("low"))
        return counted.select("node", "low")

    links, roots, tried = None, None, None
    for turn in range(ROUNDS):
        stars = held_against(rooted(roots), turn).select(F.least("node", "low").alias("a"), F.greatest("node", "low").alias("b")).distinct()
        if tried is not None:
            stars = stars.join(tried, ["a", "b"], "left_anti")
        stars = stars.join(side("a"), "a").join(side("b"), "b").where(
            _may_link(F.col("n_a"), F.col("bits_a"), F.col("n_b"), F.col("bits_b"), percent)).select("a", "b")
        found, pairs = verified(stars, "star")
        tried = pairs if tried is None else tried.union(pairs)
        if not found.count():
            break
        links = found if links is None else links.union(found)
        roots = components(links)

    named = rooted(roots)
    mixed = (named.groupBy("shingle", "tile").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
             .select(F.col("shingle").alias("s"), F.col("tile").alias("t")))
    open_ = stage(named.join(mixed, same_tile, "left_semi").join(bits.select("node", "bits"), "node"), "open-tiles")
    left = open_.select(F.col("node").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"), F.col("at").alias("pa"), F.col("bits").alias("ba"), "shingle", "tile")
    right = open_.where("band = tile").select(F.col("node").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"), F.col("at").alias("pb"),
                                              F.col("bits").alias("bb"), F.col("shingle").alias("s2"), F.col("tile").alias("t2"))
    drop_stages(tiles)
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    crossing = left.join(right, (F.col("shingle") == F.col("s2")) & (F.col("tile") == F.col("t2")) & (F.col("ra") != F.col("rb")) & smaller
                         & _room(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), percent)
                         & _may_link(F.col("na"), F.col("ba"), F.col("nb"), F.col("bb"), percent))
    crossing = crossing.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    crossed, _ = verified(crossing, "cross")
    drop_stages(open_, bits)
    links = crossed if links is None else crossed.union(roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")))
    roots = components(links)

    named = classes.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select(
        "node", "class_id", F.coalesce("root", "node").alias("root"))
    ids = named.groupBy(F.col("root").alias("r")).agg(F.min("class_id").alias("component_id"))
    found = named.join(ids, F.col("root") == F.col("r")).select(F.col("node").alias("of"), "class_id", "component_id", F.col("root").alias("component"))
    return (rows.join(found, (F.col("node") == F.col("of")) & (F.col("n") > 0), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("class_id", "doc_id").alias("class_id"), *extra, *(["component"] if nodes else [])))
