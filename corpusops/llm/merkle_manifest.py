"""Merkle manifest of a table: a content-addressed DAG of digests, and proofs by descent from its root.

Rows are leaves, ordered in trees; runs of eight consecutive nodes become their parent until one is left. The roots of
the trees, in their own order, are the leaves of a top tree. What is stored is (digest -> children). A proof
asks for a leaf by its rank: the rank's digits, to base eight, choose the child at each level on the way down from
the root, the children not chosen are collected, and the segments are reversed to run from the leaf to the root. Requests that share
a prefix of digits descend together, so a level has at most one request for each of its nodes and no row is a hot spot.

Ranks come from range partitions: counts of the partitions give each its offset, so no tree is sorted in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .common import fold, lower_ascii

#: children of a node
WIDTH = 8
SEGMENTS = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated strings."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as ``bytes:text``, ``-`` for null: no two lists of values are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add ``rank``, from 0 within each ``group`` (null is a group) by ``order`` (nulls first); ties get ranks in any order."""
    by = [F.asc_nulls_first(c) for c in [group, *order]]
    laid = rows.withColumn("tie_", F.monotonically_increasing_id()).repartitionByRange(*by, F.asc("tie_"))
    laid = stage(laid.withColumn("part_", F.spark_partition_id()), name)
    sizes = laid.groupBy(F.col(group).alias("group_"), F.col("part_").alias("of_")).agg(F.count(F.lit(1)).alias("n_"))
    before = F.coalesce(F.sum("n_").over(W.partitionBy("group_").orderBy("of_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("group_", "of_", before.alias("before_"))  # a row for each partition and group that meet
    own = F.row_number().over(W.partitionBy("part_", group).orderBy(*[F.asc_nulls_first(c) for c in order], "tie_"))
    return (laid.withColumn("own_", own).join(sizes, (F.col("part_") == F.col("of_")) & F.col(group).eqNullSafe(F.col("group_")))
            .select(*rows.columns, (F.col("before_") + F.col("own_") - 1).cast("long").alias("rank")))


def grow(leaves: DataFrame, name: str) -> list[DataFrame]:
    """Levels of inner nodes above leaves (tree, rank, n, digest): (tree, rank, n, digest, children), lowest first.

    ``n`` is how many nodes the tree has at that level; a tree ends at the level where it has one.
    """
    levels, below = [], leaves
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        child = F.struct("rank", "digest")
        nodes = (below.where("n > 1").groupBy("tree", F.floor(F.col("rank") / WIDTH).alias("rank"))
                 .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(child))["digest"].alias("children")))  # eight children at most
        below = stage(nodes.select("tree", "rank", F.ceil(F.col("n") / WIDTH).alias("n"), digest(F.array_join("children", "")).alias("digest"), "children"),
                      f"{name}-{len(levels) + 1}")
        levels.append(below)
        most = -(-most // WIDTH)
    return levels


def records(level: DataFrame) -> DataFrame:
    """(digest, children) of a level, each digest once: equal subtrees have one record."""
    return level.groupBy(F.col("digest").alias("of")).agg(F.first("children").alias("children"))


def _segment(children: Column, chosen: Column) -> Column:
    """The siblings of a child, concatenated: those before it and those after it."""
    return F.struct(F.array_join(F.slice(children, 1, chosen), "").alias("before"),
                    F.array_join(F.slice(children, chosen + 2, WIDTH), "").alias("after"))


def descend(levels: list[DataFrame], roots: DataFrame, requests: DataFrame) -> DataFrame:
    """Answer requests (tree, rank, asked: any struct) from roots (tree, n, digest, path): (tree, asked, leaf, path).

    ``path`` holds the siblings' segments from the leaf up to the root, then the path that the tree's root came with.
    """
    rank = F.floor(F.col("rank") / WIDTH)
    bundles = requests.groupBy("tree", rank.alias("rank")).agg(
        F.collect_list(F.struct((F.col("rank") % WIDTH).cast("int").alias("digit"), "asked")).alias("bundle"))  # of eight siblings
    wanted = {1: bundles}
    for k in range(2, len(levels) + 1):
        wanted[k] = wanted[k - 1].select("tree", F.floor(F.col("rank") / WIDTH).alias("rank")).distinct()
    top_down = roots.withColumn("path", F.reverse("path"))
    here = None
    for k in range(len(levels), 0, -1):
        enter = top_down.where((F.col("n") > WIDTH ** (k - 1)) & (F.col("n") <= WIDTH ** k)).select("tree", F.lit(0).cast("long").alias("rank"), "digest", "path")
        here = enter if here is None else enter.unionByName(here)
        known = here.join(records(levels[k - 1]), F.col("digest") == F.col("of"))
        if k == 1:
            break
        chosen = known.select("tree", "rank", "path", "children", F.posexplode("children").alias("digit", "digest"))
        here = (chosen.select("tree", (F.col("rank") * WIDTH + F.col("digit")).alias("rank"), "digest",
                              F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"))
                .join(wanted[k - 1].select("tree", "rank"), ["tree", "rank"], "left_semi"))
    alone = (top_down.where("n = 1").join(bundles.drop("rank"), "tree")
             .select("tree", F.explode("bundle").alias("one"), "digest", "path")
             .select("tree", "one.asked", F.col("digest").alias("leaf"), F.reverse("path").alias("path")))
    if here is None:
        return alone
    one = known.join(bundles, ["tree", "rank"]).select("tree", "path", "children", F.explode("bundle").alias("one"))
    digit = F.col("one.digit")
    return one.select("tree", "one.asked", F.get("children", digit).alias("leaf"),
                      F.reverse(F.concat("path", F.array(_segment(F.col("children"), digit)))).alias("path")).unionByName(alone)


@dataclass
class Manifest:
    """leaves: (tree, rank, n, digest, asked); trees: (tree, name, n, subroot, path); levels: nodes above the leaves; root: a digest."""

    leaves: DataFrame
    trees: DataFrame
    levels: list[DataFrame]
    root: str | None

    def prove(self, requests: DataFrame | None = None) -> DataFrame:
        """(tree, asked, leaf, path) for requests (tree, rank, asked), by default for all leaves."""
        asked = (self.leaves if requests is None else requests).select("tree", "rank", "asked")
        return descend(self.levels, self.trees.select("tree", "n", F.col("subroot").alias("digest"), "path"), asked)


def build(rows: DataFrame, name: str = "merkle") -> Manifest:
    """Manifest of rows (tree: string, order: any orderable, digest, asked: struct).

    Trees are ordered by name, null first, then bytewise; leaves by ``order`` (nulls first), then digest.
    Repeated rows are leaves of their own. Without rows the root is null.
    """
    placed = ranked(rows, "tree", ["order", "digest"], f"{name}-laid")
    sizes = placed.groupBy(F.col("tree").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("forest", F.lit(0).cast("long"))
    names = stage(ranked(sizes, "forest", ["name"], f"{name}-names").select("forest", "name", "n", F.col("rank").alias("number")), f"{name}-trees")
    leaves = stage(placed.join(names, F.col("tree").eqNullSafe(F.col("name"))).select(F.col("number").alias("tree"), "rank", "n", "digest", "asked"), f"{name}-leaves")
    levels = grow(leaves, f"{name}-level")
    subroots = None
    for level in [leaves, *levels]:
        ended = level.where("n = 1").select(F.col("tree").alias("of_tree"), F.col("digest").alias("subroot"))
        subroots = ended if subroots is None else subroots.unionByName(ended)
    trees = stage(names.join(subroots, F.col("number") == F.col("of_tree")).select(F.col("number").alias("tree"), "forest", "name", "n", "subroot"), f"{name}-subroots")
    count = trees.count()
    if not count:
        return Manifest(leaves, trees.withColumn("path", F.lit(None).cast(SEGMENTS)), levels, None)
    top = trees.select(F.col("forest").alias("tree"), F.col("tree").alias("rank"), F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest"))
    above = grow(top, f"{name}-top")
    root = (above[-1] if above else top).first()["digest"]
    start = top.sparkSession.createDataFrame([(0, count, root, [])], f"tree long, n long, digest string, path {SEGMENTS}")
    found = descend(above, start, top.select("tree", "rank", F.struct(F.col("rank").alias("number")).alias("asked")))
    paths = found.select(F.col("asked.number").alias("of_tree"), "path")
    trees = stage(trees.join(paths, F.col("tree") == F.col("of_tree")).drop("of_tree", "forest"), f"{name}-paths")
    return Manifest(leaves, trees, levels, root)


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the segments of its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["before"], node, s["after"]))


def path_digest(path: Column) -> Column:
    """Digest of all siblings in the order of the path."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def document_manifest(docs: DataFrame, lower_case_of: int = 3) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves are digests of doc_id, source, lang, n_chars and text; lang names the tree, null being one. Where the hash of
    the id is divisible by ``lower_case_of``, the root is folded from a leaf whose text has its A-Z lower-cased. Rows without an id
    come first in their tree and are not tampered with; rows with one id go by digest; equal rows stand beside one another.
    Texts of any length count whole. Empty tables give no rows.
    """
    def leaf(text: Column) -> Column:
        return digest(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))

    changed = F.when(fold("doc_id", lower_case_of) == 0, leaf(lower_ascii(F.col("text").cast("string"))))
    rows = docs.select(F.col("lang").cast("string").alias("tree"), F.col("doc_id").alias("order"), leaf(F.col("text")).alias("digest"),
                       F.struct("doc_id", changed.alias("changed")).alias("asked"))
    manifest = build(rows)
    proofs = manifest.prove().join(manifest.trees.select(F.col("tree").alias("of_tree"), "subroot"), F.col("tree") == F.col("of_tree"))
    told = proofs.select("asked.doc_id", "leaf", "subroot", F.lit(manifest.root).alias("root"), path_digest(F.col("path")).alias("proof_sha256"),
                         fold_path(F.coalesce("asked.changed", "leaf"), F.col("path")).alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
