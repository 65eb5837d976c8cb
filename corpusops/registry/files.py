"""Queries that write files and read them back: archives, headers, sinks, manifests, rules and dates."""

from __future__ import annotations

import csv
import io
import lzma
import os
import uuid
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..functions.calendars import ENGLISH, RUSSIAN
from ..functions.spans import remove_dates
from ..operators import links as L
from ..operators import rules as R
from ..operators.features import vocabulary_sizes
from ..plans.classify import run_classification
from ..session import work_dir
from ..sources import readers, sinks
from .base import NEWS, SCORED, documents, news, query, scored, sentences_sql, table, terms_sql
from .labels import _ANY_SQL, _RULES


def _scratch(spark, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


_DOCS_SQL = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, text FROM documents"


def _packed(spark, sf_dir, suffix: str, sep: str) -> str:
    """Every partition of the documents as one archive in a folder; the archives differ in the order of their columns."""
    folder = _scratch(spark, "archives")
    local = folder.removeprefix("file:")

    def pack(frames):
        columns = None
        for frame in frames:
            columns = columns or (["doc_id", "source", "text"] if frame["doc_id"].iloc[0] % 2 else ["text", "doc_id", "source"])
            out = io.StringIO(newline="")
            writer = csv.writer(out, delimiter=sep)
            writer.writerow(columns)
            writer.writerows(frame[columns].itertuples(index=False))
            os.makedirs(local, exist_ok=True)
            path = f"{local}/{uuid.uuid4().hex}{suffix}"
            if suffix == ".zip":
                with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("rows.csv", out.getvalue())
            else:
                # scratch files, read once: the fastest preset, whose search for matches costs a fraction of the usual one's
                with lzma.open(path, "wt", encoding="utf-8", newline="", preset=0) as file:
                    file.write(out.getvalue())
            yield pd.DataFrame({"rows": [len(frame)]})

    documents(spark, sf_dir).mapInPandas(pack, "rows long").agg(F.sum("rows")).collect()
    return f"{folder}/*{suffix}"


@query(_DOCS_SQL)
def zip_archives(spark, sf_dir):
    return readers.read_zip(spark, _packed(spark, sf_dir, ".zip", ";")).select("doc_id", "source", "text")


@query(_DOCS_SQL)
def xz_archives(spark, sf_dir):
    return readers.read_xz(spark, _packed(spark, sf_dir, ".xz", "\t")).select("doc_id", "source", "text")


@query(_DOCS_SQL)
def comma_round_trip(spark, sf_dir):
    return readers.read_news(spark, sinks.write_delimited(documents(spark, sf_dir), _scratch(spark, "news") + ".csv", sep=","))


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 3 <> 2 THEN source END AS source, text, CASE WHEN doc_id % 3 = 2 THEN lang END AS lang FROM documents""")
def mixed_headers(spark, sf_dir):
    """Plain and gzip files of three different headers under one path, united by name."""
    docs, folder = table(spark, sf_dir, "documents"), _scratch(spark, "mixed")
    for part, columns, compressed in ((0, ["doc_id", "source", "text"], False), (1, ["text", "source", "doc_id"], True), (2, ["lang", "text", "doc_id"], False)):
        sinks.write_delimited(docs.where(F.col("doc_id") % 3 == part).select(*columns), f"{folder}/{part}.csv", compressed=compressed)
    return readers.read_delimited(spark, [f"{folder}/{part}.csv" for part in range(3)]).select("doc_id", "source", "text", "lang")


@query("SELECT 'news' AS name, count(*) AS rows FROM documents UNION ALL SELECT 'turns', count(*) FROM conversations")
def read_many(spark, sf_dir):
    """Several sources by name, each by its own suffix and separator."""
    paths = {"news": sinks.write_delimited(documents(spark, sf_dir), _scratch(spark, "news") + ".csv.gz", compressed=True),
             "turns": sinks.write_delimited(table(spark, sf_dir, "conversations"), _scratch(spark, "turns") + ".csv", sep=",")}
    out = None
    for name, rows in readers.read_sources(spark, paths).items():
        counted = rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = counted if out is None else out.union(counted)
    return out


@query("SELECT lpad(CAST(doc_id AS VARCHAR), 9, '0') AS code, doc_id, n_chars / 7.0::DOUBLE AS share, lang FROM documents WHERE doc_id % 2 = 0")
def newest_output(spark, sf_dir):
    """Two outputs and one that is not complete: the newest complete one, with its types."""
    docs, folder = table(spark, sf_dir, "documents"), _scratch(spark, "outputs")
    rows = docs.select(F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("code"), "doc_id", (F.col("n_chars") / 7).alias("share"), "lang")
    sinks.save_table(rows.where("doc_id % 2 = 1"), folder, "b_first")
    sinks.save_table(rows.where("doc_id % 2 = 0"), folder, "a_second")
    rows.limit(1).write.csv(f"{folder}/c_broken.csv")  # written, but never committed
    return readers.read_output(spark, readers.latest_file(spark, folder))


@query("SELECT page_id AS nid, page_id % 7 AS index, url AS text, url AS link, 'page ' || page_id AS extracted_text FROM pages")
def saved_link_texts(spark, sf_dir):
    """Link rows and link rows with texts, written and read back typed."""
    rows = table(spark, sf_dir, "pages").select(F.col("url").alias("link"), (F.col("page_id") % 7).alias("index"), F.col("url").alias("text"), F.col("page_id").alias("nid"))
    links = readers.read_output(spark, sinks.save_links(rows, _scratch(spark, "links") + ".csv"))
    texts = links.withColumn("extracted_text", F.concat(F.lit("page "), F.col("nid").cast("string")))
    return readers.read_output(spark, sinks.save_link_texts(texts, _scratch(spark, "texts") + ".csv"))


@query(f"WITH {NEWS} SELECT date, link AS url, channel, 'documents' AS data_source, CAST(doc_id % 2 AS INTEGER) AS true_label, content, lower(content) AS final_processed_text FROM news")
def saved_corpus(spark, sf_dir):
    rows = news(spark, sf_dir).select(
        "content", F.lower("content").alias("final_processed_text"), "date", F.col("link").alias("url"), "channel", F.lit("documents").alias("data_source"),
        (F.col("doc_id") % 2).cast("int").alias("true_label"), "doc_id")
    return readers.read_output(spark, sinks.save_corpus(rows, _scratch(spark, "corpus") + ".csv.gz"))


@query(f"""WITH {NEWS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, 0 AS true_label, CASE WHEN {_ANY_SQL.replace('(text,', '(content,')} THEN 1 ELSE 0 END AS predicted_label FROM news""")
def saved_classification(spark, sf_dir):
    """A comma-separated gzip file, classified by rules, with its metrics appended; the rows as written."""
    path = sinks.write_delimited(news(spark, sf_dir), _scratch(spark, "news") + ".csv.gz", sep=",", compressed=True)
    folder = _scratch(spark, "classified")
    written, _ = run_classification(spark, path, _RULES, folder, f"{folder}/metrics.json", label_type="negative")
    return readers.read_output(spark, written, sep=",").select("doc_id", "true_label", "predicted_label")


@query(f"WITH {SCORED} SELECT data_type AS dataset_type, doc_id, predicted_label, round(predicted_probability, 6) AS predicted_probability FROM scored")
def saved_predictions(spark, sf_dir):
    """Predictions of all splits in one write, a folder for each split."""
    rows = scored(spark, sf_dir).select("doc_id", "predicted_label", "predicted_probability", F.col("data_type").alias("dataset_type"))
    path = sinks.save_split_predictions(rows, _scratch(spark, "splits"), add_date=False)
    kinds = "doc_id long, predicted_label int, predicted_probability double, dataset_type string"
    back = spark.read.schema(kinds).csv(path, header=True, sep=";", quote='"', escape='"')
    return back.withColumn("predicted_probability", F.round("predicted_probability", 6)).select("dataset_type", "doc_id", "predicted_label", "predicted_probability")


@query(f"WITH {SCORED} SELECT doc_id, predicted_label FROM scored")
def saved_results(spark, sf_dir):
    rows = scored(spark, sf_dir).select("doc_id", "predicted_label")
    return readers.read_output(spark, sinks.save_predictions(rows, _scratch(spark, "results"), compressed=True, add_date=True))


@query(f"""WITH freq AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({terms_sql('text')})) AS term FROM documents) GROUP BY term)
SELECT CAST(v AS INTEGER) AS min_df, count(*) FILTER (df >= v) AS vocab_size FROM range(5, 100, 10) t(v), freq GROUP BY v""")
def saved_vocabulary_sizes(spark, sf_dir):
    sizes = vocabulary_sizes(documents(spark, sf_dir), "text", range(5, 100, 10))
    return readers.read_output(spark, sinks.save_vocabulary_sizes(sizes, _scratch(spark, "sizes")), sep=",")


@query(f"""WITH {SCORED} SELECT '007' AS df_name, data_type, count(*) AS total_data, round(avg(true_label), 2) AS share FROM scored GROUP BY data_type
UNION ALL SELECT '007', 'all', count(*), round(avg(true_label), 2) FROM scored""")
def appended_metrics(spark, sf_dir):
    """A store without keys, appended to; names that look like numbers stay strings."""
    path = _scratch(spark, "metrics") + ".json"
    rows = scored(spark, sf_dir)

    def told(df):
        return df.agg(F.count("*").alias("total_data"), F.avg("true_label").alias("share")).select(F.lit("007").alias("df_name"), "data_type", "total_data", "share")

    sinks.append_metrics(told(rows.groupBy("data_type")), path, append=False)
    sinks.append_metrics(told(rows.groupBy(F.lit("all").alias("data_type"))), path)
    return sinks.load_metrics(spark, path)


# rules ------------------------------------------------------------------------------------------------

_QUOTE = "regexp_extract(text, '^[A-Za-z]+ [A-Za-z]+ [A-Za-z]+')"


@query(f"""WITH q AS (SELECT DISTINCT lower({_QUOTE}) AS q FROM benchmark WHERE {_QUOTE} <> '')
SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM q WHERE contains(lower(text), q)) THEN 1 ELSE 0 END AS predicted_label FROM documents""")
def many_rules(spark, sf_dir):
    """Ten thousand rules from a file: the first words of the benchmark passages, and codes that no text holds."""
    quotes = table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", r"^[A-Za-z]+ [A-Za-z]+ [A-Za-z]+", 0).alias("q")).where("q <> ''").distinct()
    codes = spark.range(10_000).select(F.format_string(r"code-%05d[a-z]?/\d+", F.col("id")).alias("regexp"))
    listed = quotes.select(F.concat(F.lit("(?i)"), "q").alias("regexp")).union(codes)
    rules = readers.read_rules(spark, sinks.write_delimited(listed, _scratch(spark, "rules") + ".csv", sep=","))
    return R.classify(documents(spark, sf_dir), rules, "text").select("doc_id", "predicted_label")


# dates, nulls, citations --------------------------------------------------------------------------------

_DAY = "DATE '2023-01-01' + CAST(doc_id % 700 AS INTEGER)"


@query(f"""SELECT doc_id, CASE WHEN doc_id % 9 = 8 THEN NULL WHEN doc_id % 9 IN (0, 4) THEN CAST({_DAY} AS TIMESTAMP) + INTERVAL 10 HOUR + INTERVAL 5 MINUTE
  ELSE CAST({_DAY} AS TIMESTAMP) END AS parsed FROM documents""")
def parse_date_formats(spark, sf_dir):
    return D.parse_dates(_written_dates(spark, sf_dir), "parsed", formats=D.DAY_FIRST + D.MONTH_FIRST[1:])


@query("SELECT count(*) AS rows, count(*) FILTER (doc_id % 18 = 17) AS nulls, count(*) FILTER (doc_id % 18 = 8) AS unparsed FROM documents")
def unparsed_dates(spark, sf_dir):
    return D.unparsed_dates(_written_dates(spark, sf_dir), "parsed", D.DAY_FIRST + D.MONTH_FIRST[1:])


def _written_dates(spark, sf_dir):
    day = F.date_add(F.lit("2023-01-01").cast("date"), (F.col("doc_id") % 700).cast("int"))
    forms = ["dd.MM.yyyy 10:05", "d MMM yyyy", "MMMM d, yyyy", "yyyyMMdd", "yyyy-MM-dd 10:05:00+03:00", "d/M/yyyy", "yyyy/MM/dd", "MMM d, yyyy"]
    kind, value = F.col("doc_id") % 9, F.when(F.col("doc_id") % 18 == 8, "next week")
    for i, form in enumerate(forms):
        date, _, clock = form.partition(" 10:05")
        value = F.when(kind == i, F.concat(F.date_format(day, date), F.lit(" 10:05" + clock if "10:05" in form else ""))).otherwise(value)
    return documents(spark, sf_dir).select("doc_id", value.alias("parsed"))


@query(f"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN text END AS text FROM documents)
SELECT doc_id, coalesce(text, '') AS filled, CASE WHEN text IS NULL THEN 1 ELSE CAST(len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) AS INTEGER) END AS words,
  CASE WHEN text IS NULL THEN 0 ELSE CAST(len({sentences_sql('text')}) AS INTEGER) END AS sentences FROM t""")
def null_texts(spark, sf_dir):
    """A third of the texts missing: they are empty, count as one word and have no sentence."""
    text = F.when(F.col("doc_id") % 3 > 0, F.col("text"))
    return documents(spark, sf_dir).select("doc_id", T.or_empty(text).alias("filled"), T.word_count(text).alias("words"), F.size(T.sentences(text)).alias("sentences"))


#: a citation with numbers around it, and what is left: numbers of the citation stay, others go
_CITATIONS = [
    ("по ст. 228 ук рф дали 5 лет и 300 рублей штрафа", "по ст 228 ук рф дали лет и рублей штрафа"),
    ("закон № 54-фз, принят 45 депутатами", "закон 54 фз принят депутатами"), ("статья 20.2 коап, 17 человек", "статья 20.2 коап человек"),
    ("указ 7 и 300 рублей", "указ 7 и рублей"), ("постановление 17 пункта, 12 окон", "постановление 17 пункта окон"), ("просто 300 рублей", "просто рублей"),
]
_CITATION_ROWS = ", ".join(f"({i}, '{kept}')" for i, (_, kept) in enumerate(_CITATIONS))


@query(f"""WITH c(i, kept) AS (VALUES {_CITATION_ROWS})
SELECT doc_id, kept || ' номер ' || source AS kept FROM (SELECT doc_id, regexp_replace(lower(source), '[^a-z]', '', 'g') AS source FROM documents) JOIN c ON doc_id % {len(_CITATIONS)} = i""")
def law_citations(spark, sf_dir):
    given = F.array(*[F.lit(text) for text, _ in _CITATIONS])
    text = F.concat(F.get(given, (F.col("doc_id") % len(_CITATIONS)).cast("int")), F.lit(". Номер "), F.regexp_replace(F.lower("source"), "[^a-z]", ""))
    rows = documents(spark, sf_dir).select("doc_id", text.alias("kept"))
    return remove_dates(rows, "kept", calendar=RUSSIAN | ENGLISH)


# pages fetched more than once ------------------------------------------------------------------------------

@query("SELECT url, CASE WHEN max(page_id) % 2 = 0 THEN 'again ' ELSE 'page ' END || max(page_id) AS page_text FROM pages GROUP BY url")
def last_fetched_texts(spark, sf_dir):
    """Pages fetched twice, the newer text sorting first: the last fetch counts, not the last text."""
    pages = table(spark, sf_dir, "pages")
    first = pages.select("url", F.concat(F.lit("<div class='m'>page "), F.col("page_id").cast("string"), F.lit("</div>")).alias("html"), (2 * F.col("page_id")).alias("at"))
    again = pages.where("page_id % 2 = 0").select("url", F.concat(F.lit("<div class='m'>again "), F.col("page_id").cast("string"), F.lit("</div>")).alias("html"),
                                                  (2 * F.col("page_id") + 1).alias("at"))
    return L.page_texts(first.union(again), tag="div", cls="m", fetched="at")
