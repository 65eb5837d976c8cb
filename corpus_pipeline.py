"""The corpus flow: quality rules, quality classifier, near-duplicate removal, source mixing, piece encoding.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the rows for the next.
Every stage sees all rows that the one before kept, as a Parquet table in the shared work folder, so a
lost executor repeats tasks of one stage only. All but the last return the columns of ``documents``;
further columns come along.

Nulls, empty texts and tables, repeated rows: see the operators. Rows without a doc_id are judged,
compared, mixed and encoded like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.llm import jaccard_join, mixing, neighbour_votes, quality_rules, sentence_pieces
from corpusops.llm.common import count_words, table
from corpusops.llm.queries import PIECES
from corpusops.session import stage

#: near duplicates: words of a shingle, least similarity in percent
SHINGLE_WORDS, SIMILARITY = 5, 80


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the certified rules."""
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"), carry=docs.columns)
    return judged.where("kept").select("carried.*")


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives label 1."""
    scored = neighbour_votes.classify(docs, table(spark, sf_dir, "labels"), carry=docs.columns)
    return scored.where("predicted = 1").select("row.*")


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, once: that with the smallest id, then the smallest digest.

    Rows without an id come after those with one, and different texts under one id are different documents.
    Texts without a word stand alone; those without an id are all kept.
    """
    found = jaccard_join.linked_components(docs, SHINGLE_WORDS, SIMILARITY, nodes=True)
    linked = found.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first"))
    first = linked.select("first.doc_id", "first.digest").union(
        found.where("component IS NULL AND doc_id IS NOT NULL").select("doc_id", "digest").distinct())
    first = first.select(F.col("doc_id").alias("id"), F.col("digest").alias("first"))
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row")).withColumn("text_digest", jaccard_join.text_digest(F.col("row.text").cast("string")))
    kept = own.join(first, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("text_digest") == F.col("first")), "left_semi")
    kept = kept.withColumn("own_id", F.col("row.doc_id")).dropDuplicates(["own_id", "text_digest"]).select("row.*")
    return kept.union(docs.where(F.col("doc_id").isNull() & (count_words("text") == 0)))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    taken = mixing.mix(docs).groupBy("doc_id", "digest").agg(F.max("copies").alias("copies")).where("copies > 0")
    taken = taken.select(F.col("doc_id").alias("id"), F.col("digest").alias("of_text"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row")).withColumn("own", mixing.text_digest(F.col("row.text")))
    return own.join(taken, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("of_text"))).select("row.*")


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces, pieces, and the crc32 of the decoded text, for every row of the mix."""
    keyed = docs.select(F.struct("doc_id", "lang", "source").alias("key"), "text")
    decoded = sentence_pieces.decode(sentence_pieces.encode(keyed, PIECES, key="key"), PIECES)
    return decoded.select("key.*", F.size("pieces").cast("long").alias("n_pieces"), "pieces", F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


STAGES = [
    ("quality rules", rules_stage),
    ("quality classifier", classifier_stage),
    ("n-gram Jaccard join", duplicates_stage),
    ("mixing sources", mixing_stage),
    ("SentencePiece encoding", pieces_stage),
]

#: votes among latent vectors and piece encoding have no SQL; tests compare every stage with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, "pipeline-" + name.lower().replace(" ", "-"))
    return docs
