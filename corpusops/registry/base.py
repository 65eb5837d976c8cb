"""Registration of queries with their oracle SQL, and the stand-in tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: whitespace and word classes in the oracle's dialect
WS = r"[\t-\r\x1C-\x20\x85\p{Z}]"
NWS = r"[^\t-\r\x1C-\x20\x85\p{Z}]"
W = r"[\p{L}\p{N}_]"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows to all cores if the scan has fewer splits than cores; a no-op on large tables."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


_LINK = {
    0: ("https://t.me/", "/"), 1: ("https://www.", ".ru/"), 2: ("http://", ".co.uk/"), 3: ("ftp://", ".com/"),
}


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as news: doc_id is the row position, the source the channel; date and link derived."""
    docs = documents(spark, sf_dir)
    kind = F.col("doc_id") % 5
    link = F.lit("https://t.me/")
    for k, (head, tail) in _LINK.items():
        link = F.when(kind == k, F.concat(F.lit(head), "source", F.lit(tail), F.col("doc_id").cast("string"))).otherwise(link)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    return docs.select("doc_id", F.col("source").alias("channel"), link.alias("link"),
                       day.cast("timestamp_ntz").alias("date"), F.col("text").alias("content"))


NEWS = """news AS (SELECT doc_id, source AS channel,
  CASE doc_id % 5 WHEN 0 THEN 'https://t.me/' || source || '/' || doc_id WHEN 1 THEN 'https://www.' || source || '.ru/' || doc_id
    WHEN 2 THEN 'http://' || source || '.co.uk/' || doc_id WHEN 3 THEN 'ftp://' || source || '.com/' || doc_id
    ELSE 'https://t.me/' END AS link,
  CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS TIMESTAMP) AS date, text AS content FROM documents)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """news with true_label (quality; null where a document has no label)."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("true_label"))
    return news(spark, sf_dir).join(labels, "doc_id", "left")


LABELLED = NEWS + """, labelled AS (SELECT news.*, quality AS true_label FROM news LEFT JOIN labels USING (doc_id))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and prediction rows from the tables: quality as label, a score with ties from the text length."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels")
    score = (F.col("n_chars") % 97) / 100.0 + F.col("toxic") * 0.02
    return labels.join(docs, "doc_id").select(
        "doc_id", F.col("lang").alias("data_type"), F.col("quality").alias("true_label"),
        score.alias("predicted_probability"), (score >= 0.4).cast("int").alias("predicted_label"))


SCORED = """scored AS (SELECT doc_id, lang AS data_type, quality AS true_label,
  (n_chars % 97) / 100.0::DOUBLE + toxic * 0.02::DOUBLE AS predicted_probability,
  CASE WHEN (n_chars % 97) / 100.0::DOUBLE + toxic * 0.02::DOUBLE >= 0.4 THEN 1 ELSE 0 END AS predicted_label
  FROM labels JOIN documents USING (doc_id))"""


def tokens_sql(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '{WS}+'), lambda w: w <> '')"


def sentences_sql(text: str) -> str:
    stripped = rf"regexp_replace(regexp_replace({text}, '^{WS}+', ''), '{WS}+$', '')"
    return rf"list_filter(string_split(regexp_replace({stripped}, '([.!?…]){WS}+', '\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')"


def terms_sql(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '{W}{{2,}}')"


def clean_sql(text: str, legacy_email: bool = False) -> str:
    steps = [
        ("<.*?>", ""), ("[\u200b\u200c\u200d\ufeff]", ""), ("&nbsp;", " "), ("[A-Za-z0-9_-]{25,}", " "),
        (r"[\x{24C2}-\x{10FFFF}]+", " "), (f"#{NWS}+", " "),
    ]
    if not legacy_email:
        steps.append((r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", " "))
    steps += [
        (f"@{NWS}+", " "), (rf"http[s]?://{NWS}+|www\.{NWS}+", " "), ("[@/]", " "),
        ("([.!?:])([А-ЯЁ])", r"\1 \2"), (f"{WS}+", " "),
    ]
    for pattern, replacement in steps:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return f"trim({text})"


LETTERS = "а-яА-ЯёЁa-zA-Z"


def tidy_sql(text: str) -> str:
    steps = [
        (rf"[^{LETTERS}0-9.:\t-\r\x1C-\x20\x85\p{{Z}}]", " "), (rf"{WS}+\.({NWS})", r".\1"),
        (rf"([^0-9]){WS}+\.([^0-9])", r"\1.\2"), (r"([0-9])\.", "\\1\x01"), ("[.:]", ""), ("\x01", "."), (f"{WS}+", " "),
    ]
    for pattern, replacement in steps:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return f"trim({text})"


def undated_ctes(source: str, year: int) -> str:
    """CTEs from ``source`` (doc_id, lower-cased t, pub) to ``undated``, for texts without Cyrillic."""
    date = r"\b(?:\d{1,2}[./]\d{1,2}[./]\d{4}|\d{4}-\d{1,2}-\d{1,2}|\d{4})\b"
    part = "string_split(replace(x, '/', '.'), '.')"
    return rf"""mentions AS (SELECT doc_id, pub, regexp_split_to_array(t, '{date}') AS g, list_transform(regexp_extract_all(t, '{date}'), lambda x: [x, CAST(coalesce(
    try_cast(CASE WHEN length(x) = 4 THEN x || '-01-01' WHEN x[5] = '-' THEN x ELSE {part}[3] || '-' || {part}[2] || '-' || {part}[1] END AS DATE),
    DATE '0001-01-01') AS VARCHAR)]) AS x FROM {source}),
resolved AS (SELECT doc_id, array_to_string(list_transform(list_zip(g, x), lambda p: regexp_replace(coalesce(p[1], ''), '[^{LETTERS}]+', ' ', 'g') || CASE
    WHEN p[2] IS NULL THEN '' WHEN p[2][2] = '0001-01-01' OR (length(p[2][1]) = 4 AND CAST(p[2][1] AS INTEGER) NOT BETWEEN 2001 AND 2049) THEN ' '
    WHEN year(CAST(p[2][2] AS DATE)) = {year} OR CAST(p[2][2] AS DATE) >= pub THEN ''
    ELSE ' ' || p[2][1] || ' ' END), '') AS t FROM mentions),
undated AS (SELECT doc_id, {tidy_sql('t')} AS undated FROM resolved)"""


def hash_sql(seed: str, key: str = "doc_id") -> str:
    return f"('0x' || substr(md5('{seed}|' || {key}), 1, 8))::BIGINT"
