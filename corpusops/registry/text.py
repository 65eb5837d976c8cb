"""Queries of the row-local text functions."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.regex import apply_regex
from ..functions.calendars import ENGLISH, RUSSIAN
from ..functions.spans import remove_dates
from ..operators import frames
from ..operators.dedup import distinct_in_order
from ..operators.lemmas import lemmatize
from .base import (
    LETTERS, W, WS, clean_sql, documents, query, sentences_sql, terms_sql, tidy_sql, tokens_sql, undated_ctes,
)

# every cleaning step has something to remove in these texts
_DIRTY_SQL = ("'<b>' || source || '</b>&nbsp;' || chr(8203) || text || ' https://' || source || '.com/x?a=b www.' || source "
              "|| '.ru @' || source || ' a.' || doc_id || '@mail.ru #' || source || ' Да.Нет ' || chr(128512) || 'и/или '")


def _dirty():
    s, d = F.col("source"), F.col("doc_id").cast("string")
    lit = F.lit
    return F.concat(lit("<b>"), s, lit("</b>&nbsp;\u200b"), F.col("text"), lit(" https://"), s, lit(".com/x?a=b www."), s,
                    lit(".ru @"), s, lit(" a."), d, lit("@mail.ru #"), s, lit(" Да.Нет \U0001F600и/или "))


@query(f"SELECT doc_id, {clean_sql(_DIRTY_SQL)} AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    dirty = documents(spark, sf_dir).select("doc_id", _dirty().alias("dirty"))
    return T.clean_column(dirty, "dirty", "cleaned").select("doc_id", "cleaned")


@query(f"SELECT doc_id, {clean_sql(_DIRTY_SQL, True)} AS cleaned FROM documents")
def clean_text_keeping_email_names(spark, sf_dir):
    dirty = documents(spark, sf_dir).select("doc_id", _dirty().alias("dirty"))
    return T.clean_column(dirty, "dirty", "cleaned", legacy_email=True).select("doc_id", "cleaned")


@query(f"""WITH c AS (SELECT source, {clean_sql('text')} AS cleaned FROM documents)
SELECT source, count(*) AS rows, CAST(sum(len(regexp_extract_all(cleaned, '{W}+'))) AS BIGINT) AS words
FROM c WHERE len(regexp_extract_all(cleaned, '{W}+')) >= 7 GROUP BY source""")
def clean_filter_count(spark, sf_dir):
    """Flagship: clean, drop short texts, count rows and words per source."""
    cleaned = T.clean_column(documents(spark, sf_dir), "text", "cleaned")
    kept, _ = frames.split_by_length(cleaned, "cleaned", 7)
    return kept.groupBy("source").agg(F.count("*").alias("rows"), F.sum("word_count").alias("words"))


@query(f"SELECT doc_id, CAST(len(regexp_extract_all(text, '{W}+')) AS INTEGER) AS word_count FROM documents")
def word_count(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.word_count("text").alias("word_count"))


@query(f"""SELECT doc_id, CAST(len(regexp_extract_all(text, '{W}+')) AS INTEGER) AS word_count FROM documents
WHERE len(regexp_extract_all(text, '{W}+')) >= 7""")
def word_count_filter(spark, sf_dir):
    return frames.split_by_length(documents(spark, sf_dir), "text", 7)[0].select("doc_id", "word_count")


@query(f"""SELECT doc_id, text, CAST(len(regexp_extract_all(text, '{W}+')) AS INTEGER) AS word_count FROM documents
WHERE len(regexp_extract_all(text, '{W}+')) <= 7""")
def short_rows(spark, sf_dir):
    return frames.split_by_length(documents(spark, sf_dir), "text", 7)[1].select("doc_id", "text", "word_count")


@query(r"""WITH f AS (SELECT doc_id, regexp_extract_all(text, '[0-9]+') AS m FROM documents),
u AS (SELECT doc_id, list_transform(list_filter(list_zip(m, range(1, len(m) + 1)), lambda x: list_position(m, x[1]) = x[2]), lambda x: x[1]) AS m FROM f)
SELECT doc_id, CASE len(m) WHEN 0 THEN 'none' WHEN 1 THEN m[1] ELSE '(' || array_to_string(m, ' + ') || '(' END AS numbers FROM u""")
def regex_findall_unique(spark, sf_dir):
    numbers = apply_regex("text", r"[0-9]+", "findall", unique=True, as_list=False, when_none="none", border="(")
    return documents(spark, sf_dir).select("doc_id", numbers.alias("numbers"))


@query(r"""SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]+') THEN CAST(regexp_extract(text, '[0-9]+') AS DOUBLE) ELSE 0.0 END AS first_number,
  CASE WHEN regexp_full_match(source, 'src[0-9]') THEN source ELSE 'other' END AS one_digit_source,
  CAST(len(regexp_split_to_array(text, '[.!?]')) AS INTEGER) AS pieces,
  regexp_replace(text, '([A-Z])([a-z]+)', '\2\1', 'g') AS swapped FROM documents""")
def regex_methods(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id",
        apply_regex("text", r"[0-9]+", "search", as_list=False, as_float=True).alias("first_number"),
        apply_regex("source", r"src[0-9]", "fullmatch", as_list=False, when_none="other").alias("one_digit_source"),
        F.size(apply_regex("text", r"[.!?]", "split")).alias("pieces"),
        apply_regex("text", r"([A-Z])([a-z]+)", "sub", replacement=r"\2\1").alias("swapped"))


@query(r"""WITH f AS (SELECT doc_id, regexp_extract_all(text, '[A-Z][a-z]+') AS m FROM documents)
SELECT doc_id, CASE WHEN len(m) = 0 THEN '0' WHEN len(m) = 1 THEN m[1] ELSE m[2] END AS second_name,
  array_to_string(CASE WHEN len(m) > 1 THEN [m[1]] || CASE WHEN len(m) > 2 THEN [m[3]] ELSE [] END ELSE m END, '|') AS picked FROM f""")
def regex_pick(spark, sf_dir):
    found = "[A-Z][a-z]+"
    return documents(spark, sf_dir).select(
        "doc_id",
        apply_regex("text", found, "finditer", as_list=False, pick=1).alias("second_name"),
        F.array_join(apply_regex("text", found, "finditer", pick=[0, 2]), "|").alias("picked"))


@query(f"""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^a-zà-ÿ0-9.\\t-\\r\\x1C-\\x20\\x85\\p{{Z}}]', '', 'g'), '{WS}+', ' ', 'g')) AS kept
FROM documents""")
def strip_foreign_chars(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.keep_alphabet("text", "a-zà-ÿ").alias("kept"))


_STOP = ["the", "of", "and", "to", "de", "la", "und", "el", "los", "is"]
_STOP_SQL = ", ".join(f"'{w}'" for w in _STOP)


@query(f"SELECT doc_id, array_to_string(list_filter({tokens_sql('text')}, lambda w: w NOT IN ({_STOP_SQL})), ' ') AS kept FROM documents")
def remove_stopwords(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.drop_words("text", _STOP).alias("kept"))


@query(f"""SELECT doc_id, CAST(len({tokens_sql('text')}) AS INTEGER) AS tokens, lower(text) AS lowered,
  array_to_string({terms_sql('text')}, ' ') AS terms FROM documents""")
def tokenise(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", F.size(T.tokens("text")).alias("tokens"), T.lower("text").alias("lowered"),
        F.array_join(T.terms("text"), " ").alias("terms"))


@query(f"SELECT doc_id, unnest({sentences_sql('text')}) AS sentence FROM documents")
def sentence_split(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.explode(T.sentences("text")).alias("sentence"))


@query(f"""WITH t AS (SELECT doc_id, {tokens_sql('text')} AS m FROM documents)
SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(m, range(1, len(m) + 1)), lambda x: list_position(m, x[1]) = x[2]), lambda x: x[1]), ' ') AS words FROM t""")
def distinct_words_in_order(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.array_join(distinct_in_order(T.tokens("text")), " ").alias("words"))


@query(f"SELECT doc_id, trim(regexp_replace(text, '[^{LETTERS}]+', ' ', 'g')) AS letters FROM documents")
def letters_only(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.letters_only("text").alias("letters"))


@query(f"SELECT doc_id, {tidy_sql('text')} AS tidy FROM documents")
def tidy_punctuation(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.tidy_punctuation("text").alias("tidy"))


# the dictionary maps every word of the corpus that ends in s to the word without it
@query(f"""SELECT doc_id, array_to_string(list_transform({tokens_sql('text')},
  lambda w: CASE WHEN length(w) > 3 AND suffix(w, 's') THEN left(w, length(w) - 1) ELSE w END), ' ') AS lemmas FROM documents""")
def lemma_join(spark, sf_dir):
    docs = documents(spark, sf_dir)
    forms = docs.select(F.explode(F.array_distinct(T.tokens("text"))).alias("form")).distinct()
    table = forms.where((F.length("form") > 3) & F.col("form").endswith("s")).select(
        "form", F.col("form").substr(F.lit(1), F.length("form") - 1).alias("lemma"))
    return lemmatize(docs, table, "text", "lemmas").select("doc_id", "lemmas")


#: text before a mention, the mention, its date when told on 2024-12-01 (a Sunday), text after it
_MENTIONS = [
    ("суд решил", "вчера", "DATE '2024-12-01' - 1", "дело"), ("он пришел", "два дня назад", "DATE '2024-12-01' - 2", "домой"),
    ("итог", "год назад", "DATE '2024-12-01' - INTERVAL 1 YEAR", "был"), ("встреча", "двадцать два месяца назад", "DATE '2024-12-01' - INTERVAL 22 MONTH", "была"),
    ("заседание в", "пятницу", "DATE '2024-11-29'", "прошло"), ("это было в", "марте", "DATE '2024-03-01'", "там"), ("решение от", "17.04.23", "DATE '2023-04-17'", "отменено"),
    ("приговор", "5 мая 2023", "DATE '2023-05-05'", "вынесен"), ("апелляция", "через три недели", "DATE '2024-12-01' + 21", "будет"),
    ("выборы в", "прошлом году", "DATE '2024-12-01' - INTERVAL 1 YEAR", "были"), ("she came", "yesterday", "DATE '2024-12-01' - 1", "with him"),
    ("it was", "thirteen", None, "or so"), ("they left", "twenty months ago", "DATE '2024-12-01' - INTERVAL 20 MONTH", "from there"),
    ("the vote", "on", None, "that"), ("the court met", "last friday", "DATE '2024-11-29' - 7", "then"), ("a law of", "november 9, 2023", "DATE '2023-11-09'", "was"),
    ("это", "статья 20.3", None, "коап"), ("закон", "дошел", None, "вчерашний"),
]
_MENTION_ROWS = ", ".join(f"({i}, '{a}', '{m}', {f'CAST({d} AS DATE)' if d else 'NULL'}, '{b}')" for i, (a, m, d, b) in enumerate(_MENTIONS))


@query(f"""WITH m(i, a, mention, told, b) AS (VALUES {_MENTION_ROWS}),
d AS (SELECT doc_id, lower(text) AS t, TIMESTAMP '2023-01-01' + to_days(CAST(doc_id % 365 AS INTEGER)) AS pub FROM documents),
{undated_ctes('d', 2024)},
kept AS (SELECT d.doc_id, a || ' ' || CASE WHEN told IS NOT NULL AND (year(told) = 2024 OR told >= pub) THEN '' ELSE replace(mention, ',', '') || ' ' END || b AS front
  FROM d JOIN m ON doc_id % {len(_MENTIONS)} = i)
SELECT doc_id, trim(front || ' ' || undated) AS undated FROM kept JOIN undated USING (doc_id)""")
def relative_dates_removed(spark, sf_dir):
    """Relative mentions, weekdays, bare months and short years in Russian and English, told on a fixed day."""
    rows = F.array(*[F.lit(f"{a.capitalize()} {m} {b} . ") for a, m, _, b in _MENTIONS])
    text = F.concat(F.get(rows, (F.col("doc_id") % len(_MENTIONS)).cast("int")), F.col("text"))
    published = F.date_add(F.lit("2023-01-01").cast("date"), F.col("doc_id").cast("int") % 365).cast("timestamp_ntz")
    dated = documents(spark, sf_dir).select("doc_id", text.alias("undated"), published.alias("published"))
    return remove_dates(dated, "undated", "published", as_of=datetime.date(2024, 12, 1), calendar=RUSSIAN | ENGLISH).select("doc_id", "undated")


_DATED_SQL = ("'on ' || strftime(DATE '2022-06-01' + CAST(doc_id % 700 AS INTEGER), '%Y-%m-%d') || ' or ' || "
              "strftime(DATE '2023-06-01' - CAST(doc_id % 500 AS INTEGER), '%d.%m.%Y') || ' in 2019. ' || text")


@query(f"""WITH d AS (SELECT doc_id, lower({_DATED_SQL}) AS t, TIMESTAMP '2023-01-01' + to_days(CAST(doc_id % 365 AS INTEGER)) AS pub FROM documents),
{undated_ctes('d', 2024)} SELECT doc_id, undated FROM undated""")
def ascii_dates_removed(spark, sf_dir):
    d = F.col("doc_id").cast("int")
    first = F.date_add(F.lit("2022-06-01").cast("date"), d % 700)
    second = F.date_format(F.date_sub(F.lit("2023-06-01").cast("date"), d % 500), "dd.MM.yyyy")
    text = F.concat(F.lit("on "), first.cast("string"), F.lit(" or "), second, F.lit(" in 2019. "), F.col("text"))
    published = F.date_add(F.lit("2023-01-01").cast("date"), d % 365).cast("timestamp_ntz")
    dated = documents(spark, sf_dir).select("doc_id", text.alias("undated"), published.alias("published"))
    return remove_dates(dated, "undated", "published", as_of=datetime.date(2024, 12, 1)).select("doc_id", "undated")
