"""Queries of the table operators: shape, filters, dates, duplicates, samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import urls as U
from ..functions.hashing import hash_fraction
from ..operators import frames
from ..operators.dedup import drop_known, keep_best, lookup_last
from ..operators.sampling import split_sizes as sizes_of
from ..operators.sampling import stratified_sample as sample
from ..operators.sampling import time_split as split
from ..operators.sampling import take_by_hash, with_folds
from ..session import work_dir
from ..sources.readers import latest_file as newest
from ..sources.readers import read_delimited, read_news
from ..sources.sinks import load_metrics, save_metrics, write_delimited
from .base import LABELLED, NEWS, SCORED, documents, hash_sql, labelled, news, query, scored, table


def _int(column):
    return F.col(column).cast("int")


# shape ----------------------------------------------------------------------------------------------

@query("SELECT doc_id AS nid, text AS content, source AS link, lang FROM documents")
def rename_present(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("nid"), F.col("text").alias("summary"), "source", "lang")
    return frames.standard_names(docs, "summary", "created_at", "source")


@query("SELECT text AS content FROM documents")
def single_column(spark, sf_dir):
    return frames.adopt_single_column(table(spark, sf_dir, "documents").select("text"))


@query("""SELECT TRY_CAST(CASE WHEN doc_id % 7 = 0 THEN 'x' ELSE CAST(doc_id AS VARCHAR) END AS BIGINT) AS nid, 1 AS true_label, 'documents' AS data_source
FROM documents WHERE text <> ''""")
def labelled_projection(spark, sf_dir):
    docs = frames.non_empty(table(spark, sf_dir, "documents"), "text")
    nid = F.when(F.col("doc_id") % 7 == 0, "x").otherwise(F.col("doc_id").cast("string"))
    return frames.with_constants(frames.with_long_id(docs.select(nid.alias("nid")), "nid"), true_label=1, data_source="documents")


# every third text, every fifth link and every seventh date is null
_HOLES = """holes AS (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN content END AS content, CASE WHEN doc_id % 5 > 0 THEN link END AS link,
  CASE WHEN doc_id % 7 > 0 THEN date END AS date FROM news)"""


def _holes(spark, sf_dir):
    def hole(column, n):
        return F.when(F.col("doc_id") % n > 0, F.col(column)).alias(column)
    return news(spark, sf_dir).select("doc_id", hole("content", 3), hole("link", 5), hole("date", 7))


@query(f"""WITH {NEWS}, {_HOLES}
SELECT 'content' AS "column", count(*) FILTER (content IS NULL) AS dropped FROM holes
UNION ALL SELECT 'link', count(*) FILTER (content IS NOT NULL AND link IS NULL) FROM holes
UNION ALL SELECT 'date', count(*) FILTER (content IS NOT NULL AND link IS NOT NULL AND date IS NULL) FROM holes""")
def null_counts(spark, sf_dir):
    return frames.null_counts(_holes(spark, sf_dir))


@query(f"WITH {NEWS}, {_HOLES} SELECT * FROM holes WHERE content IS NOT NULL AND link IS NOT NULL AND date IS NOT NULL")
def drop_nulls(spark, sf_dir):
    return frames.drop_nulls(_holes(spark, sf_dir))


@query(f"WITH {NEWS}, {_HOLES} SELECT doc_id, content FROM holes WHERE content IS NOT NULL")
def not_null_text(spark, sf_dir):
    return frames.not_null(_holes(spark, sf_dir), "content").select("doc_id", "content")


@query(f"WITH {NEWS} SELECT link, channel, content, content AS final_processed_text FROM news")
def filled_columns(spark, sf_dir):
    data = frames.with_default(news(spark, sf_dir).withColumn("predicted_labels", F.lit(None).cast("int")), "final_processed_text", "content")
    return frames.select_filled(data, ["link", "channel", "content", "final_processed_text", "predicted_labels", "predicted_probability"])


@query("""SELECT doc_id AS id, text AS content, source AS channel, 'documents' AS data_source, NULL AS role FROM documents
UNION ALL SELECT item_id, text, NULL, 'benchmark', NULL FROM benchmark
UNION ALL SELECT conv_id, text, NULL, 'conversations', role FROM conversations""")
def union_by_name(spark, sf_dir):
    text = F.col("text").alias("content")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), text, F.col("source").alias("channel"))
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), text)
    turns = table(spark, sf_dir, "conversations").select("role", F.col("conv_id").alias("id"), text)
    return frames.union_sources(*[
        frames.with_constants(df, data_source=name)
        for df, name in ((docs, "documents"), (items, "benchmark"), (turns, "conversations"))
    ]).select("id", "content", "channel", "data_source", "role")


# links and channels ---------------------------------------------------------------------------------

@query(rf"""WITH {NEWS} SELECT doc_id, link, CASE
  WHEN contains(link, 't.me') THEN CASE string_split(string_split(link, 't.me/')[-1], '/')[1] WHEN '' THEN 'Unknown tg channel' ELSE string_split(string_split(link, 't.me/')[-1], '/')[1] END
  WHEN regexp_extract(link, 'https?://(www\.)?([^/]+)', 2) = '' THEN 'Channel name was not found'
  ELSE regexp_replace(regexp_extract(link, 'https?://(www\.)?([^/]+)', 2), '\.(ru|com|org|net|info|edu|gov|io)$', '') END AS channel FROM news""")
def channel_from_url(spark, sf_dir):
    return frames.with_channel(news(spark, sf_dir).select("doc_id", "link"))


@query(r"SELECT page_id, url, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) AS host FROM pages")
def link_authority(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", U.authority("url").alias("host"))


@query(f"WITH {NEWS} SELECT doc_id, CASE WHEN contains(link, 't.me') THEN link || '?embed=1&mode=tme' ELSE link END AS page_link FROM news")
def embed_links(spark, sf_dir):
    return news(spark, sf_dir).select("doc_id", U.embed_link("link").alias("page_link"))


# one source in 20 becomes a null channel, which both filters keep
_CHANNELS = "ch AS (SELECT doc_id, CASE WHEN source <> 'src3' THEN upper(source) END AS channel FROM documents)"


def _channels(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("source") != "src3", F.upper("source")).alias("channel"))


@query(f"WITH {_CHANNELS} SELECT * FROM ch WHERE channel IS NULL OR NOT contains(lower(channel), 'src1')")
def channel_exclude(spark, sf_dir):
    return frames.exclude_channel_like(_channels(spark, sf_dir), "src1")


@query(f"WITH {_CHANNELS} SELECT * FROM ch WHERE channel IS NULL OR channel NOT IN ('SRC1', 'SRC2')")
def channel_not_in(spark, sf_dir):
    return frames.exclude_channels(_channels(spark, sf_dir), ["SRC1", "SRC2"])


# dates ----------------------------------------------------------------------------------------------

@query("SELECT event_id, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'")
def date_range(spark, sf_dir):
    return frames.date_range(table(spark, sf_dir, "events"), "2024-01-10", "2024-01-20", "ts").select("event_id", "user_id", "value")


_STAMP_SQL = """CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+03:00'
  WHEN 2 THEN '2024-13-45 10:00:00' ELSE 'bad' END"""


def _stamps(spark, sf_dir):
    kind = F.col("event_id") % 4
    plain = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    offset = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00"))
    stamp = F.when(kind == 0, plain).when(kind == 1, offset).when(kind == 2, "2024-13-45 10:00:00").otherwise("bad")
    return table(spark, sf_dir, "events").select("event_id", stamp.alias("date"))


@query(f"""WITH s AS (SELECT event_id, {_STAMP_SQL} AS date FROM events)
SELECT event_id, TRY_CAST(regexp_replace(date, '[+-][0-9]{{2}}:[0-9]{{2}}$', '') AS TIMESTAMP) AS date FROM s""")
def parse_dates(spark, sf_dir):
    return D.parse_dates(_stamps(spark, sf_dir), "date")


@query(f"""WITH s AS (SELECT event_id, {_STAMP_SQL} AS date FROM events)
SELECT event_id, TRY_CAST(regexp_replace(date, '[+-][0-9]{{2}}:[0-9]{{2}}$', '') AS TIMESTAMP)
  - CASE WHEN regexp_matches(date, '[+-][0-9]{{2}}:[0-9]{{2}}') THEN INTERVAL 3 HOUR ELSE INTERVAL 0 HOUR END AS date FROM s""")
def parse_dates_to_utc(spark, sf_dir):
    return D.parse_dates(_stamps(spark, sf_dir), "date", to_utc=True)


@query(f"WITH s AS (SELECT event_id, {_STAMP_SQL} AS date FROM events) SELECT event_id, CAST(regexp_matches(date, '[+-][0-9]{{2}}:[0-9]{{2}}') AS INTEGER) AS offset_found FROM s")
def has_offset(spark, sf_dir):
    return _stamps(spark, sf_dir).select("event_id", D.has_offset("date").cast("int").alias("offset_found"))


# duplicates and lookups -----------------------------------------------------------------------------

@query(f"""WITH {LABELLED}, r AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY CASE WHEN true_label = 1 THEN 1 ELSE 0 END DESC, doc_id DESC) AS rn FROM labelled)
SELECT doc_id, channel, true_label, content FROM r WHERE rn = 1""")
def dedup_label_priority(spark, sf_dir):
    return keep_best(labelled(spark, sf_dir).select("doc_id", "channel", "true_label", "content"), "channel", "doc_id")


@query(f"""WITH {LABELLED}, r AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY CASE WHEN true_label = 1 THEN 1 ELSE 0 END DESC, doc_id DESC) AS rn FROM labelled)
SELECT doc_id, channel, true_label, content FROM r WHERE rn = 1""")
def dedup_by_text(spark, sf_dir):
    return keep_best(labelled(spark, sf_dir).select("doc_id", "channel", "true_label", "content"), "content", "doc_id")


@query(f"""WITH {LABELLED} SELECT doc_id, content FROM labelled WHERE coalesce(true_label, 0) <> 1
AND content NOT IN (SELECT content FROM labelled WHERE true_label = 1)""")
def others_without_positives(spark, sf_dir):
    rows = labelled(spark, sf_dir).select("doc_id", "content", "true_label")
    positive = F.coalesce(F.col("true_label") == 1, F.lit(False))
    return drop_known(rows.where(~positive), rows.where(positive), "content").select("doc_id", "content")


@query("""SELECT u.user_id, e.event_type AS last_event FROM (SELECT DISTINCT user_id + (user_id % 2) * 1000000 AS user_id FROM events) u
LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id) e USING (user_id)""")
def lookup_last_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    users = events.select((F.col("user_id") + F.col("user_id") % 2 * 1000000).alias("user_id")).distinct()
    return lookup_last(users, events, "user_id", "event_type", "event_id", "last_event")


# samples and splits ---------------------------------------------------------------------------------

@query(f"""WITH n AS (SELECT lang, round_even(count(*) / (SELECT count(*) FROM documents)::DOUBLE * 101, 0)::BIGINT AS q FROM documents GROUP BY lang),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {hash_sql('42')}, doc_id) <= q AS taken FROM documents JOIN n USING (lang)),
t AS (SELECT doc_id, lang, row_number() OVER (ORDER BY {hash_sql('42-trim')}, doc_id) AS rn FROM r WHERE taken),
f AS (SELECT doc_id, lang, row_number() OVER (ORDER BY {hash_sql('42-fill')}, doc_id) AS rn FROM r WHERE NOT taken)
SELECT doc_id, lang FROM t WHERE rn <= 101
UNION ALL SELECT doc_id, lang FROM f WHERE rn <= 101 - (SELECT count(*) FROM t)""")
def stratified_sample(spark, sf_dir):
    return sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), 101, "lang", "doc_id")


@query(f"SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY {hash_sql('7')}, doc_id) AS rn FROM documents) WHERE rn <= 77")
def sample_by_hash(spark, sf_dir):
    return take_by_hash(table(spark, sf_dir, "documents").select("doc_id", "lang"), 77, "doc_id", 7)


_DRAW = hash_sql("42", "event_id") + " / 4294967296.0::DOUBLE"
_SPLIT_SQL = f"""SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN CASE WHEN {_DRAW} < 0.1 THEN 'train_holdout' ELSE 'train' END
  ELSE CASE WHEN {_DRAW} < 0.5 THEN 'dev' ELSE 'test' END END AS dataset_type FROM events WHERE ts IS NOT NULL"""


@query(_SPLIT_SQL)
def time_split(spark, sf_dir):
    return split(table(spark, sf_dir, "events").select("event_id", "ts"), "event_id", "ts", "2024-01-20").select("event_id", "dataset_type")


@query(f"SELECT dataset_type, count(*) AS rows FROM ({_SPLIT_SQL}) GROUP BY dataset_type")
def split_sizes(spark, sf_dir):
    return sizes_of(time_split(spark, sf_dir))


@query(f"""SELECT doc_id, CAST({hash_sql('42-fold')} % 5 AS INTEGER) AS fold, {hash_sql('42-draw')} / 4294967296.0::DOUBLE AS draw FROM documents""")
def cross_validation_folds(spark, sf_dir):
    return with_folds(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


# files ----------------------------------------------------------------------------------------------

def _scratch(spark, name):
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, text FROM documents")
def csv_round_trip(spark, sf_dir):
    path = write_delimited(documents(spark, sf_dir), _scratch(spark, "news") + ".csv")
    return read_news(spark, path)


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, text FROM documents")
def gzip_round_trip(spark, sf_dir):
    path = write_delimited(documents(spark, sf_dir), _scratch(spark, "news") + ".csv.gz", compressed=True)
    return read_news(spark, path)


@query("SELECT conv_id, role, count(*) AS rows FROM conversations GROUP BY conv_id, role")
def record_counts(spark, sf_dir):
    """Records, not physical lines: the texts hold line breaks."""
    path = write_delimited(table(spark, sf_dir, "conversations"), _scratch(spark, "turns") + ".csv")
    rows = read_delimited(spark, path).groupBy("conv_id", "role").agg(F.count("*").alias("rows"))
    return rows.withColumn("conv_id", F.col("conv_id").cast("long"))


@query()
def latest_file(spark, sf_dir):
    path = newest(spark, sf_dir, (".parquet",))
    return spark.read.parquet(path).agg(F.count("*").alias("rows")).withColumn("path", F.lit(path))


@query(f"""WITH {SCORED} SELECT 'm1' AS model_name, data_type, count(*) AS total_data, round(avg(true_label), 2) AS share FROM scored GROUP BY data_type HAVING data_type <> 'de'
UNION ALL SELECT 'm1', data_type, 2 * count(*), round(avg(predicted_label), 2) FROM scored WHERE data_type = 'de' GROUP BY data_type""")
def metrics_store(spark, sf_dir):
    """Save metrics per data type, then save one of them again: its old row is replaced."""
    path = _scratch(spark, "metrics")
    rows = scored(spark, sf_dir).withColumn("model_name", F.lit("m1")).groupBy("model_name", "data_type")
    first = rows.agg(F.count("*").alias("total_data"), F.avg("true_label").alias("share"))
    again = rows.agg((2 * F.count("*")).alias("total_data"), F.avg("predicted_label").alias("share")).where("data_type = 'de'")
    save_metrics(first, path)
    save_metrics(again, path)
    return load_metrics(spark, path, first).select("model_name", "data_type", "total_data", "share")
