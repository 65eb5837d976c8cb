"""Proofs by descent against trees that are built and folded node by node."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from corpusops.llm import merkle_manifest
from corpusops.llm.queries import QUERIES

from .support import COLUMNS, awkward, empty

SMALL = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, tampered=False):
    out = ""
    for name in FIELDS:
        value = row[name]
        if value is not None and name == "text" and tampered:
            value = "".join(c.lower() if "A" <= c <= "Z" else c for c in value)
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return sha(out)


def tree(nodes):
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, range(len(at))):
            begin = at[i] // 8 * 8
            run = nodes[begin:begin + 8]
            path.append(("".join(run[:at[i] - begin]), "".join(run[at[i] - begin + 1:])))
            at[i] //= 8
        nodes = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    names = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for name in names:
        own = sorted(by[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append((own, *tree([leaf(r) for r in own])))
    if not trees:
        return []
    root, tops = tree([t[1] for t in trees])
    out = []
    for (own, subroot, paths), top in zip(trees, tops):
        for r, path in zip(own, paths):
            path = path + top
            node = leaf(r, r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0)
            for before, after in path:
                node = sha(before + node + after)
            out.append((r["doc_id"], leaf(r), subroot, root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def check(docs):
    rows = [r.asDict() for r in docs.select(*FIELDS).collect()]
    assert sorted(map(tuple, merkle_manifest.document_manifest(docs).collect()), key=repr) == plain_manifest(rows)


def test_query_equals_plain_trees(spark):
    rows = [r.asDict() for r in spark.read.parquet(SMALL + "/documents.parquet").collect()]
    got = QUERIES["op12_merkle_manifest"](spark, SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == plain_manifest(rows)
    assert {r.verified for r in got} == {True, False}


def test_many_trees_of_all_heights_null_and_repeated_ids(spark):
    pick = random.Random(4)
    names = [None, "", "é", "en", *(f"l{i}" for i in range(12))]
    rows = [(pick.choice([None, *range(40)]), pick.choice([None, "", "Aé b", "xY"]), pick.choice(names), pick.choice([None, "a"]), pick.choice([None, 3])) for _ in range(150)]
    rows += [(i, f"T{i}", "deep", "a", i) for i in range(600)] + [(1, "Same", "copies", "a", 1)] * 70
    check(spark.createDataFrame(rows, COLUMNS))


def test_manifest_awkward_rows(spark):
    docs = awkward(spark)
    for name in ("tree", "rank", "digest", "order", "asked", "path", "leaf", "root", "of"):
        docs = docs.withColumn(name, F.lit("clash"))
    check(docs)
    check(docs.where("doc_id = 3"))
    assert merkle_manifest.document_manifest(empty(spark)).count() == 0


def test_requests_descend_only_where_asked(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 300, "x").otherwise("y").alias("tree"), F.col("id").alias("order"),
                                    F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"), F.struct("id").alias("asked"))
    manifest = merkle_manifest.build(rows)
    some = manifest.leaves.where("asked.id IN (0, 7, 299, 300, 999)")
    proofs = manifest.prove(some)
    got = {r.id: (r.leaf, r.node, len(r.path)) for r in proofs.select("asked.id", "leaf", "path", merkle_manifest.fold_path(F.col("leaf"), F.col("path")).alias("node")).collect()}
    assert sorted(got) == [0, 7, 299, 300, 999]
    assert all(v == (sha(str(i)), manifest.root, (3 if i < 300 else 4) + 1) for i, v in got.items())


def test_equal_subtrees_share_a_record(spark):
    rows = spark.range(640).select(F.lit("x").alias("tree"), F.lit(1).alias("order"), F.lit(sha("same")).alias("digest"), F.struct("id").alias("asked"))
    manifest = merkle_manifest.build(rows)
    assert [merkle_manifest.records(level).count() for level in manifest.levels] == [1, 1, 2, 1]  # the third has runs of eight and of two
    proofs = manifest.prove().select(merkle_manifest.fold_path(F.col("leaf"), F.col("path")).alias("node"))
    assert proofs.count() == 640 and proofs.distinct().count() == 1
