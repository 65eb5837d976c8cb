import datetime

import pytest
from pyspark.sql import functions as F

from corpusops.functions import dates as D
from corpusops.functions import urls as U
from corpusops.operators import dedup, frames, sampling
from corpusops.session import stage

DT = datetime.datetime


def collect(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("link, channel", [
    ("https://t.me/chan/12", "chan"),
    ("https://t.me/s/chan", "s"),
    ("https://t.me/", "Unknown tg channel"),
    ("https://t.me", "https:"),
    ("https://chat.mesite.com/x", "https:"),
    ("https://x.y/t.me/a/t.me/b/c", "b"),
    ("https://www.site.ru/a", "site"),
    ("https://site.co.uk/a", "site.co.uk"),
    ("http://site.com:8080/a", "site.com:8080"),
    ("ftp://site.com/a", "Channel name was not found"),
    (None, None),
])
def test_channel_name(values, link, channel):
    assert values(U.channel_name, [link]) == [channel]


@pytest.mark.parametrize("link, kept", [
    ("https://www.own.org/x", True), ("https://own.org:80/x", True), ("https://u@other.org/p", True), ("https://OWN.org/x", True),
    ("https://own.org/x", False), ("//own.org/x", False), ("/rel", False), ("mailto:a@b.c", False), ("tel:1", False), ("", False),
])
def test_is_external(values, link, kept):
    assert values(lambda v: U.is_external(v, {"own.org"}), [link]) == [kept]


def test_authority(values):
    assert values(U.authority, ["http://u:p@h:1/x?y", "//h/x", " https://h#f", "h/x"]) == ["u:p@h:1", "h", "h", ""]


def test_dates(values):
    inputs = ["2024-06-01T10:00:00+03:00", "2024-05-31 23:59:59", "2024-13-45 10:00:00", "bad", None]
    assert values(D.wall_clock, inputs) == [DT(2024, 6, 1, 10), DT(2024, 5, 31, 23, 59, 59), None, None, None]
    assert values(lambda v: D.wall_clock(v, to_utc=True), inputs)[:2] == [DT(2024, 6, 1, 7), DT(2024, 5, 31, 23, 59, 59)]
    assert values(D.has_offset, inputs) == [True, False, False, False, None]


def test_date_range_is_half_open_and_drops_nulls(spark):
    dates = ["2024-06-01 00:00:00", "2024-07-01 00:00:00", "2024-05-31 23:59:59", None]
    df = spark.createDataFrame([(d,) for d in dates], "date string")
    assert collect(frames.date_range(df, "2024-06-01", "2024-07-01")) == [(DT(2024, 6, 1),)]
    assert frames.date_range(df, "2024-06-01").count() == 2
    assert frames.date_range(df).count() == 4


def test_date_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = plan_of(frames.date_range(events, "2024-01-10", "2024-01-20", "ts").select("event_id"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp" in plan


def test_renames_skip_absent_columns(spark):
    df = spark.createDataFrame([("s", "d")], "summary string, created_at string")
    assert frames.standard_names(df, "summary", "created_at", "nope").columns == ["content", "date"]
    assert frames.adopt_single_column(df.select("summary")).columns == ["content"]
    assert frames.adopt_single_column(df).columns == ["summary", "created_at"]
    assert frames.rename_first(df, "nid").columns == ["nid", "created_at"]


def test_null_removal_counts_in_turn(spark):
    rows = [("t", "l", "d"), (None, None, "d"), ("t", None, None), ("t", "l", None)]
    df = spark.createDataFrame(rows, "content string, link string, date string")
    assert collect(frames.null_counts(df)) == [("content", 1), ("date", 1), ("link", 1)]
    assert frames.drop_nulls(df).count() == 1
    assert frames.drop_nulls(df.select("content")).count() == 3
    assert frames.null_counts(df.select(F.col("date").alias("x"))).count() == 0


def test_channel_filters_keep_nulls(spark):
    df = spark.createDataFrame([("OwnNews",), ("other",), (None,)], "channel string")
    assert collect(frames.exclude_channel_like(df, "ownnews")) == [("other",), (None,)]
    assert collect(frames.exclude_channels(df, ["other"])) == [("OwnNews",), (None,)]
    assert frames.exclude_channel_like(df.toDF("x"), "own").count() == 3


def test_length_split_overlaps_at_the_bound(spark):
    df = spark.createDataFrame([("a b c d e f g",), ("a b",), ("a b c d e f g h",)], "content string")
    kept, short = frames.split_by_length(df)
    assert collect(kept, "word_count") == [(7,), (8,)]
    assert collect(short, "word_count") == [(2,), (7,)]


def test_select_filled(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "link string, channel string")
    assert frames.select_filled(df, ["link", "channel", "content"]).columns == ["link"]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="nope"):
        frames.require(spark.range(1), "id", "nope")


ROWS = [("a", 0, 1), ("a", 1, 2), ("a", 1, 3), ("b", 0, 4), ("b", 0, 5), (None, 0, 6), (None, 0, 7), ("c", None, 8)]


def test_keep_best(spark):
    df = spark.createDataFrame(ROWS, "link string, true_label int, pos int")
    best = dedup.keep_best(df, "link", "pos")
    assert collect(best, "pos") == [(3,), (5,), (7,), (8,)]
    assert collect(dedup.keep_best(best, "link", "pos")) == collect(best)


def test_keep_best_limits_hot_keys_before_the_shuffle(spark):
    """A key with a third of all rows must not be shipped to one task whole."""
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', string(id)) link", "int(id % 2) true_label", "id pos").repartition(3)
    best = dedup.keep_best(df, "link", "pos")
    assert best.count() == 2001
    plan = plan_of(best)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_lookup_last_and_anti_join(spark):
    left = spark.createDataFrame([(1,), (2,)], "nid long")
    right = spark.createDataFrame([(1, "d1", 1), (1, "d2", 2)], "nid long, created_at string, pos int")
    assert collect(dedup.lookup_last(left, right, "nid", "created_at", "pos", "date")) == [(1, "d2"), (2, None)]
    df = spark.createDataFrame(ROWS, "link string, true_label int, pos int")
    known = df.where("link is null or link = 'a'")
    assert collect(dedup.drop_known(df, known, "link"), "pos") == [(4,), (5,), (8,)]


@pytest.mark.parametrize("sizes, target, expected", [
    ({"x": 50, "y": 30, "z": 20}, 10, {"x": 5, "y": 3, "z": 2}),
    ({"x": 5, "y": 5}, 1, None),  # both quotas round half to even to 0: one row is filled in
    ({"x": 5, "y": 5, "z": 5, "w": 5}, 6, None),  # 4 x 1.5 rounds to 8: two rows are trimmed
])
def test_stratified_sample(spark, sizes, target, expected):
    rows = [(g, f"{g}{i}") for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "g string, k string")
    sample = sampling.stratified_sample(df, target, "g", "k", cells=4)
    got = [tuple(r) for r in sample.collect()]
    assert len(got) == len(set(got)) == target and set(got) <= set(rows)
    if expected:
        assert {g: sum(1 for r in got if r[0] == g) for g in sizes} == expected


@pytest.mark.parametrize("count", [0, 1, 37, 100, 1000])
def test_take_by_hash_is_exact_at_any_cell_count(spark, count):
    df = spark.range(300)
    want = {r[0] for r in df.orderBy(sampling.hash32(42, "id"), "id").limit(count).collect()}
    for cells in (1, 16, 65536):
        got = [r[0] for r in sampling.take_by_hash(df, count, "id", cells=cells).collect()]
        assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("target, scans", [(1234, 3), (1235, 4)])
def test_sample_reads_the_table_once_for_each_step(spark, monkeypatch, target, scans):
    """Counts, cut cells, (rows that rounding adds,) result: one scan each, and only cut cells are ranked."""
    df = spark.range(5000).selectExpr("if(id >= 2500, 'hot', 'cold') g", "id k")
    written = []
    monkeypatch.setattr(sampling, "stage", lambda df, name: written.append((name, plan_of(df))) or stage(df, name))
    sample = sampling.stratified_sample(df, target, "g", "k")
    assert sample.count() == target
    plans = [plan for _, plan in written] + [plan_of(sample)]
    assert sum(plan.count("Range (0, 5000") for plan in plans) == scans
    assert [name for name, plan in written if "row_number" in plan] == ["hash-cuts"]
    assert "Join" in dict(written)["hash-cuts"]


def test_time_split_is_disjoint_and_whole(spark):
    df = spark.range(4000).selectExpr("id k", "case when id % 10 = 0 then null when id % 2 = 0 then '2024-05-31' else '2024-06-01 00:00:00' end date")
    split = sampling.time_split(df, "k").persist()
    sizes = {r["dataset_type"]: r["rows"] for r in sampling.split_sizes(split).collect()}
    assert set(sizes) == {"train", "train_holdout", "dev", "test"} and sum(sizes.values()) == 3600
    assert split.select("k").distinct().count() == 3600
    assert split.where("dataset_type in ('dev', 'test') and k % 2 = 0").count() == 0
    assert 0.06 < sizes["train_holdout"] / 1600 < 0.14 and 0.45 < sizes["dev"] / 2000 < 0.55
    assert "Exchange" not in plan_of(sampling.time_split(df, "k"))


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("b",)], "y string")
    assert collect(frames.union_sources(a, b)) == [(1, None), (None, "b")]


@pytest.mark.parametrize("text, date", [
    ("15.03.2024", DT(2024, 3, 15)), ("1.3.2024 10:05", DT(2024, 3, 1, 10, 5)), ("01/03/2024 10:05:09", DT(2024, 3, 1, 10, 5, 9)), ("5 Mar 2024", DT(2024, 3, 5)),
    ("5 March 2024 1:02", DT(2024, 3, 5, 1, 2)), ("20240305", DT(2024, 3, 5)), ("2024/3/5", DT(2024, 3, 5)), ("2024-03-05 01:02:03+03:00", DT(2024, 3, 5, 1, 2, 3)),
    ("45.13.2024", None), ("soon", None), ("", None), (None, None),
])
def test_other_date_formats(spark, text, date):
    df = spark.createDataFrame([(text,)], "d string")
    assert D.parse_dates(df, "d", formats=D.DAY_FIRST).first()[0] == date
    assert tuple(D.unparsed_dates(df, "d", D.DAY_FIRST).first()) == (1, int(text is None), int(text is not None and date is None))


def test_month_first_dates(spark):
    df = spark.createDataFrame([("3/15/2024",), ("Mar 5, 2024",), ("March 5, 2024 7:08",)], "d string")
    assert [r[0] for r in D.parse_dates(df, "d", formats=D.MONTH_FIRST).collect()] == [DT(2024, 3, 15), DT(2024, 3, 5), DT(2024, 3, 5, 7, 8)]
