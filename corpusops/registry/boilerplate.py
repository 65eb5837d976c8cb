"""Queries of the channel statistics and the whole text treatment."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..operators import channels as C
from ..plans.textflow import TextOptions, process_texts
from .base import NEWS, WS, clean_sql, news, query, sentences_sql, tokens_sql, undated_ctes


@query(f"WITH {NEWS} SELECT channel, count(*) AS rows FROM news GROUP BY channel")
def value_counts(spark, sf_dir):
    return C.rows_per_channel(news(spark, sf_dir))


@query("SELECT DISTINCT source AS channel FROM documents")
def distinct_channels(spark, sf_dir):
    return C.channels(news(spark, sf_dir))


def _frequent_sql(table: str, text: str, min_rows: int = 5) -> str:
    return f"""s AS (SELECT channel, unnest({sentences_sql(text)}) AS sentence FROM {table}),
sc AS (SELECT channel, sentence, count(*) AS occurrences FROM s GROUP BY channel, sentence),
n AS (SELECT channel, count(*) AS rows FROM {table} GROUP BY channel),
freq AS (SELECT channel, sentence, occurrences, rows FROM sc JOIN n USING (channel) WHERE rows > {min_rows} AND occurrences / rows > 0.05)"""


@query(f"WITH {NEWS}, {_frequent_sql('news', 'content')} SELECT * FROM freq")
def frequent_sentences(spark, sf_dir):
    return C.frequent_sentences(news(spark, sf_dir), text="content", min_rows=5)


_REMOVED = f"""lists AS (SELECT channel, list(sentence) AS unwanted FROM freq GROUP BY channel),
kept AS (SELECT doc_id, channel, date, array_to_string(list_filter({sentences_sql('content')}, lambda s: NOT list_contains(coalesce(unwanted, []), s)), ' ') AS content
  FROM news LEFT JOIN lists USING (channel))"""


@query(f"WITH {NEWS}, {_frequent_sql('news', 'content')}, {_REMOVED} SELECT doc_id, content FROM kept")
def remove_frequent_sentences(spark, sf_dir):
    data = news(spark, sf_dir)
    frequent = C.frequent_sentences(data, text="content", min_rows=5)
    return C.remove_sentences(data, frequent, text="content").select("doc_id", "content")


@query(f"WITH w AS (SELECT unnest({tokens_sql('text')}) AS word FROM documents) SELECT word, count(*) AS total FROM w GROUP BY word")
def word_totals(spark, sf_dir):
    return C.word_totals(news(spark, sf_dir), "content")


def _scores_sql(table: str, text: str) -> str:
    return f"""w AS (SELECT channel, unnest({tokens_sql(text)}) AS word FROM {table}),
c AS (SELECT channel, word, count(*) AS n FROM w GROUP BY channel, word),
scores AS (SELECT channel, word, n, CAST(sum(n) OVER (PARTITION BY word) AS BIGINT) AS total, n / sum(n) OVER (PARTITION BY word) AS score FROM c)"""


@query(f"WITH {NEWS}, {_scores_sql('news', 'content')} SELECT channel, word, n, total, round(score, 6) AS score FROM scores")
def channel_word_scores(spark, sf_dir):
    words = C.channel_words(news(spark, sf_dir), text="content")
    return words.withColumn("score", F.round("score", 6))


@query(f"""WITH {NEWS}, {_scores_sql('news', 'content')},
r AS (SELECT channel, word, n, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY channel ORDER BY score DESC, n DESC, word) AS INTEGER) AS rank FROM scores)
SELECT * FROM r WHERE rank <= 5""")
def exclusive_words_topn(spark, sf_dir):
    return C.exclusive_words(news(spark, sf_dir), text="content").withColumn("score", F.round("score", 6))


@query(f"""WITH {NEWS}, t AS (SELECT channel, doc_id, {tokens_sql('content')} AS words FROM news),
w AS (SELECT channel, doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM t),
c AS (SELECT channel, word, count(*) AS n, min(doc_id * 1000000 + pos) AS place FROM w GROUP BY channel, word),
s AS (SELECT channel, word, n, place, n / sum(n) OVER (PARTITION BY word) AS score FROM c),
r AS (SELECT channel, word, n, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY channel ORDER BY score DESC, place) AS INTEGER) AS rank FROM s)
SELECT * FROM r WHERE rank <= 5""")
def exclusive_words_first_seen(spark, sf_dir):
    return C.exclusive_words(news(spark, sf_dir), text="content", order="doc_id").withColumn("score", F.round("score", 6))


def _words_removed_sql(table: str, text: str, top_n: int) -> str:
    return f"""{_scores_sql(table, text)},
r AS (SELECT channel, word, row_number() OVER (PARTITION BY channel ORDER BY score DESC, n DESC, word) AS rank FROM scores),
wl AS (SELECT channel, list(word) AS unwanted_words FROM r WHERE rank <= {top_n} GROUP BY channel)
SELECT doc_id, array_to_string(list_filter({tokens_sql(text)}, lambda w: NOT list_contains(coalesce(unwanted_words, []), w)), ' ') AS final_processed_text
FROM {table} LEFT JOIN wl USING (channel)"""


@query(f"WITH {NEWS}, {_words_removed_sql('news', 'content', 3)}")
def remove_exclusive_words(spark, sf_dir):
    data = news(spark, sf_dir)
    words = C.exclusive_words(data, text="content", top_n=3)
    return C.remove_channel_words(data, words, text="content").select("doc_id", "final_processed_text")


@query(f"SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS final_processed_text FROM documents")
def keep_exclusive_words(spark, sf_dir):
    """Word removal switched off, as the reported statistics alone leave the texts."""
    data = news(spark, sf_dir)
    return C.remove_channel_words(data, data, text="content", enabled=False).select("doc_id", "final_processed_text")


_STOP = ("the", "of", "and", "to", "de", "la", "und", "el", "los", "is")
_ALPHABET = "a-zà-ÿ"
_OPTIONS = TextOptions(stopwords=_STOP, alphabet=_ALPHABET, min_channel_rows=5, as_of=datetime.date(2000, 1, 1))
_STOP_SQL = ", ".join(f"'{w}'" for w in _STOP)
_STOPPED = f"array_to_string(list_filter({tokens_sql('undated')}, lambda w: w NOT IN ({_STOP_SQL})), ' ')"
_KEPT = rf"trim(regexp_replace(regexp_replace({_STOPPED}, '[^{_ALPHABET}0-9.\t-\r\x1C-\x20\x85\p{{Z}}]', '', 'g'), '{WS}+', ' ', 'g'))"


@query(f"""WITH {NEWS.replace('news AS', 'raw AS')}, news AS (SELECT doc_id, channel, date, {clean_sql('content')} AS content FROM raw),
{_frequent_sql('news', 'content')}, {_REMOVED},
d AS (SELECT doc_id, lower(content) AS t, date AS pub FROM kept), {undated_ctes('d', 2000)},
normal AS (SELECT doc_id, channel, {_KEPT} AS content FROM undated JOIN kept USING (doc_id)),
{_words_removed_sql('normal', 'content', 3)}""")
def full_text_processing(spark, sf_dir):
    data, _ = process_texts(news(spark, sf_dir), options=_OPTIONS)
    return data.select("doc_id", "final_processed_text")
