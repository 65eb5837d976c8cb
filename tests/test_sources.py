import csv
import datetime
import glob
import gzip
import io
import lzma
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusops.plans.prepare import prepare_frame, prepare_news
from corpusops.session import stage, work_dir
from corpusops.sources import readers as R
from corpusops.sources import manifest
from corpusops.sources import sinks as S

ROWS = [("https://t.me/a/1", 'строка "раз";\nстрока два', "2024-06-01"), ("https://b.ru/2", "текст", "2024-06-02")]
TEXT = 'link;summary;date\n' + "".join('%s;"%s";%s\n' % (l, t.replace('"', '""'), d) for l, t, d in ROWS)


def got(df):
    return sorted(tuple(r) for r in df.select("link", "summary", "date").collect())


def write(folder, name, sep=";"):
    path = str(folder / name)
    data = TEXT.replace(";\n", "\0").replace(";", sep).replace("\0", ";\n").encode()
    if name.endswith(".gz"):
        with gzip.open(path, "wb") as f:
            f.write(data)
    elif name.endswith(".xz"):
        with lzma.open(path, "wb") as f:
            f.write(data)
    elif name.endswith(".zip"):
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("readme.txt", "x")
            z.writestr("first.csv", data)
            z.writestr("second.csv", b"other\n1\n")
    else:
        with open(path, "wb") as f:
            f.write(data)
    return path


@pytest.mark.parametrize("name, sep", [("n.csv", ";"), ("n.csv", ","), ("n.csv.gz", ";"), ("n.zip", ";"), ("n.xz", "\t")])
def test_read_by_suffix(spark, tmp_path, name, sep):
    df = R.read_news(spark, write(tmp_path, name, sep))
    assert df.columns == ["link", "summary", "date"]
    assert got(df) == sorted(ROWS)


def test_comma_gzip(spark, tmp_path):
    assert got(R.read_news(spark, write(tmp_path, "n.csv.gz", ","), gz_sep=",")) == sorted(ROWS)


def test_archive_is_read_in_batches_with_short_rows_and_nulls(spark, tmp_path):
    path = str(tmp_path / "big.xz")
    with lzma.open(path, "wt", encoding="utf-8") as f:
        f.write("a\tb\n" + "".join(f"{i}\t\n" for i in range(9000)) + "last\n")
    df = R.read_news(spark, path)
    assert df.count() == 9001 and df.where("b is null").count() == 9001 and df.where("a = 'last'").count() == 1


def test_archives_are_read_by_their_own_headers(spark, tmp_path):
    for name, data in (("a.zip", "x;y\n1;2\n"), ("b.zip", "y;x;z\n9;8;7\n5\n")):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("t.csv", data)
    df = R.read_zip(spark, str(tmp_path / "*.zip"))
    assert df.columns == ["x", "y", "z"]
    assert {tuple(r) for r in df.collect()} == {("1", "2", None), ("8", "9", "7"), (None, "5", None)}


@pytest.mark.parametrize("name", ["n.csv", "n.csv.gz", "n.zip", "n.xz"])
def test_surplus_fields_are_an_error(spark, tmp_path, name):
    sep = "\t" if name.endswith(".xz") else ";"
    data = "x;y\n1;2;LOST\n3\n".replace(";", sep).encode()
    path = str(tmp_path / name)
    if name.endswith(".zip"):
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("t.csv", data)
    else:
        opener = gzip.open if name.endswith(".gz") else lzma.open if name.endswith(".xz") else open
        with opener(path, "wb") as f:
            f.write(data)
    with pytest.raises(Exception, match="more fields|has 3 fields"):
        R.read_news(spark, path).count()


def test_unreadable_sources(spark, tmp_path):
    path = str(tmp_path / "empty.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.txt", "x")
    with pytest.raises(ValueError):
        R.read_news(spark, path)
    with pytest.raises(ValueError):
        R.read_news(spark, str(tmp_path / "absent.csv.gz"))


def test_latest_file(spark, tmp_path):
    assert R.latest_file(spark, str(tmp_path)) is None
    assert R.latest_file(spark, str(tmp_path / "absent")) is None
    for i, name in enumerate(["old.csv", "new.csv.gz", "newest.txt"]):
        os.utime(write(tmp_path, name), (1e9 + i, 1e9 + i))
    assert R.latest_file(spark, str(tmp_path)).endswith("/new.csv.gz")


def test_rules_and_texts(spark, tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text('id,regexp\n1,"a,b"\n2,\n3,c\\d\n', encoding="utf-8")
    assert R.read_rules(spark, str(path)) == ["a,b", "c\\d"]
    assert [r[0] for r in R.texts_to_frame(spark, ["x", "y"]).collect()] == ["x", "y"]
    assert R.texts_to_frame(spark, "x", "t").columns == ["t"]
    assert R.row_count(R.texts_to_frame(spark, R.texts_to_frame(spark, "x"))) == 1
    with pytest.raises(ValueError):
        R.texts_to_frame(spark, 5)


def test_prepare(spark, tmp_path):
    write(tmp_path, "n.csv.gz")
    df = prepare_news(spark, str(tmp_path))
    assert sorted((r["channel"], r["date"]) for r in df.collect()) == [
        ("a", datetime.datetime(2024, 6, 1)), ("b", datetime.datetime(2024, 6, 2))]
    df = prepare_news(spark, str(tmp_path / "n.csv.gz"), exclude_like="B", filtered=True, start="2024-01-01", min_words=3)
    assert [(r["channel"], r["word_count"]) for r in df.collect()] == [("a", 4)]
    one = prepare_frame(spark.createDataFrame([("x",), (None,)], "whatever string"))
    assert [tuple(r) for r in one.collect()] == [("x",)] and one.columns == ["content"]
    with pytest.raises(ValueError):
        prepare_news(spark, str(tmp_path / "sub"))


def test_dates_under_other_names(spark):
    df = spark.createDataFrame([("t", "https://b.ru/2", "2024-06-02T10:00:00+03:00")], "body string, url string, created_at string")
    row = prepare_frame(df, content="body", link="url", date="created_at").first()
    assert (row["channel"], row["date"]) == ("b", datetime.datetime(2024, 6, 2, 10))


def test_delimited_round_trip(spark, tmp_path):
    """An empty text reads back as null, like any empty field."""
    rows = [(1, 'a "q"; b\nc\\', None), (2, "", "x")]
    df = spark.createDataFrame(rows, "nid long, t string, u string")
    for compressed in (False, True):
        path = S.save_table(df, str(tmp_path), "out", compressed)
        assert path.endswith("out.csv.gz" if compressed else "out.csv")
        back = R.read_news(spark, path)
        assert sorted(tuple(r) for r in back.collect()) == [("1", 'a "q"; b\nc\\', None), ("2", None, "x")]


def test_paths():
    day = datetime.date(2024, 6, 1)
    assert S.output_path("/x/", "n", True, True, day) == "/x/n_2024-06-01.csv.gz"
    assert S.classification_path("/x", "n") == "/x/full_n_classification.csv"
    assert S.classification_path("/x", "n", True) == "/x/filtered_n_classification.csv"


def test_metric_stores(spark, tmp_path):
    kind = "model_name string, data_type string, f1 double"
    path = str(tmp_path / "m")
    first = spark.createDataFrame([("1", "train", 0.126), ("1", "dev", 0.4)], kind)
    S.save_metrics(first, path)
    S.save_metrics(spark.createDataFrame([("1", "dev", 0.6), ("2/x", "dev", 0.7)], kind), path)
    stored = S.load_metrics(spark, path, first).select("model_name", "data_type", "f1")
    assert sorted(tuple(r) for r in stored.collect()) == [("1", "dev", 0.6), ("1", "train", 0.13), ("2/x", "dev", 0.7)]
    S.save_metrics(first.limit(1), path, append=False)
    assert S.load_metrics(spark, path).count() == 1

    log = str(tmp_path / "l")
    for append in (True, True, False, True):
        S.append_metrics(first, log, append)
    assert spark.read.json(log).count() == 4


def test_other_sinks(spark, tmp_path):
    links = spark.createDataFrame([(1, 0, "t", "l", "d")], "nid long, index int, text string, link string, created_at string")
    assert R.read_news(spark, S.save_links(links, str(tmp_path / "links.csv"))).columns == links.columns
    texts = links.selectExpr("'x' extracted_text", "*")
    assert R.read_news(spark, S.save_link_texts(texts, str(tmp_path / "texts.csv"))).columns[-1] == "extracted_text"
    corpus = spark.range(1).selectExpr(*[f"'v' {c}" for c in S.CORPUS_COLUMNS], "1 other")
    assert R.read_news(spark, S.save_corpus(corpus, str(tmp_path / "corpus.csv.gz"))).columns == S.CORPUS_COLUMNS
    sizes = spark.createDataFrame([(5, 10)], "min_df int, vocab_size long")
    assert R.read_delimited(spark, S.save_vocabulary_sizes(sizes, str(tmp_path)), ",").first()["vocab_size"] == "10"
    splits = spark.createDataFrame([("dev", 1), ("test", 2)], "dataset_type string, x int")
    path = S.save_split_predictions(splits, str(tmp_path), add_date=False)
    assert sorted(p for p in os.listdir(path) if p.startswith("dataset_type")) == ["dataset_type=dev", "dataset_type=test"]


def test_staged_table_lies_in_the_named_folder(spark):
    df = stage(spark.range(3), "t")
    assert df.count() == 3
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(work_dir(spark) in f for f in df.inputFiles())


@pytest.mark.parametrize("suffix", [".csv", ".csv.gz"])
def test_files_of_different_headers_align_by_name(spark, tmp_path, suffix):
    for name, data in (("a", 'x;y\n1;"2;\n2"\n'), ("b", "y;x;z\n9;8;7\n5\n"), ("c", ""), ("d", "\ufeffx;y\n3;4\n")):
        opener = gzip.open if suffix.endswith(".gz") else open
        with opener(tmp_path / (name + suffix), "wt", encoding="utf-8", newline="") as f:
            f.write(data)
    df = R.read_delimited(spark, str(tmp_path))
    assert df.columns == ["x", "y", "z"]
    assert {tuple(r) for r in df.collect()} == {("1", "2;\n2", None), ("8", "9", "7"), (None, "5", None), ("3", "4", None)}


def test_headers_without_or_with_repeated_names(spark, tmp_path):
    (tmp_path / "n.csv").write_text("a;;A\n1;2;3\n", encoding="utf-8")
    assert R.read_delimited(spark, str(tmp_path / "n.csv")).columns == ["a0", "_c1", "A2"]


def test_archives_are_streamed_one_partition_a_file(spark, tmp_path):
    for i in range(3):
        with lzma.open(tmp_path / f"{i}.xz", "wt", encoding="utf-8") as f:
            f.write("a\n" + "".join(f"{i}-{j}\n" for j in range(5000)))
    df = R.read_news(spark, str(tmp_path) + "/*.xz")
    assert df.rdd.getNumPartitions() == 3 and df.distinct().count() == 15_000


def test_newest_complete_output(spark, tmp_path):
    df = spark.createDataFrame([("007", 1.5, True, datetime.date(2024, 5, 1))], "code string, x double, b boolean, d date")
    write(tmp_path, "old.csv")
    os.utime(tmp_path / "old.csv", (1e9, 1e9))
    assert R.latest_file(spark, str(tmp_path)).endswith("/old.csv")
    first = S.write_delimited(df, str(tmp_path / "z.csv"))
    second = S.write_delimited(df.withColumn("x", F.lit(2.5)), str(tmp_path / "a.csv"))
    df.write.csv(str(tmp_path / "broken.csv"))
    assert R.latest_file(spark, str(tmp_path)).endswith("/a.csv")
    back = R.read_output(spark, second)
    assert back.schema == df.schema and back.first() == ("007", 2.5, True, datetime.date(2024, 5, 1))
    S.write_delimited(df, first)
    assert R.latest_file(spark, str(tmp_path)).endswith("/z.csv")
    assert [m["path"].rsplit("/", 1)[1] for m in manifest.manifests(spark, str(tmp_path))] == ["a.csv", "z.csv"]
    df.write.mode("overwrite").csv(first)  # no longer one of ours
    assert R.latest_file(spark, str(tmp_path)).endswith("/a.csv") and manifest.schema_at(spark, first) is None


def test_store_keys_that_look_like_numbers(spark, tmp_path):
    rows = spark.createDataFrame([("007", "1e5", 1, 0.5)], "model_name string, data_type string, n int, share double")
    S.save_metrics(rows, str(tmp_path / "m"))
    assert [tuple(r) for r in S.load_metrics(spark, str(tmp_path / "m")).select("model_name", "data_type", "n", "share").collect()] == [("007", "1e5", 1, 0.5)]


def test_position_of_each_text(spark):
    assert sorted(map(tuple, R.texts_to_frame(spark, ["b", "a", "b"], "t", "place").collect())) == [(0, "b"), (1, "a"), (2, "b")]


def test_scratch_archives_are_packed_fast(spark):
    """The fastest preset has a dictionary of 256 KiB; the usual one's needs more than 8 MB to unpack."""
    from corpusops.registry import files

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    paths = glob.glob(files._packed(spark, "/root/testdata/sf0.001", ".xz", "\t").removeprefix("file:"))
    found = 0
    for path in paths:
        with open(path, "rb") as f:
            text = lzma.LZMADecompressor(memlimit=2 << 20).decompress(f.read()).decode()
        found += len(list(csv.reader(io.StringIO(text, newline=""), delimiter="\t"))) - 1
    assert found == docs.count()
