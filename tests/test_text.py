import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusops.functions import patterns as P
from corpusops.functions import text as T
from corpusops.functions.regex import apply_regex


@pytest.mark.parametrize("raw, cleaned", [
    ("<b>а</b>", "а"),
    ("а&nbsp;б", "а б"),
    ("Да.Нет", "Да. Нет"),
    ("см https://a.b/c тут", "см тут"),
    ("пиши #тег сюда", "пиши сюда"),
    ("почта a@b.ru тут", "почта тут"),
    ("и/или", "и или"),
    ("ку​ку﻿", "куку"),
    ("ид abcdefghijklmnopqrstuvwxyz012345 тут", "ид тут"),
    ("да 😀😀 нет", "да нет"),
    ("漢字 да", "да"),
    ("строка<b\n>да", "строка<b >да"),
    ("а \t\nб  в", "а б в"),
    ("@кто-то сказал", "сказал"),
    ("http://user@host.ru/x да", "http: x да"),
    (None, None),
    ("", ""),
])
def test_clean_text(spark, raw, cleaned):
    df = spark.createDataFrame([(raw,)], "t string")
    assert T.clean_column(df, "t", "c").first()["c"] == cleaned
    assert df.select(T.clean_text("t")).first()[0] == cleaned


def test_legacy_email_keeps_local_part(spark):
    df = spark.createDataFrame([("почта a@b.ru тут",)], "t string")
    assert T.clean_column(df, "t", "c", legacy_email=True).first()["c"] == "почта a тут"


# fixed values: the cleaning steps in Python's dialect, in order
CLEAN_STEPS = [
    (r"<.*?>", ""), ("[\u200b\u200c\u200d\ufeff]", ""), ("&nbsp;", " "), (r"[A-Za-z0-9_-]{25,}", " "),
    ("[\u24c2-\U0010ffff]+", " "), (r"#\S+", " "), (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", " "),
    (r"@\S+", " "), (r"http[s]?://\S+|www\.\S+", " "), (r"[@/]", " "), (r"([.!?:])(?!\s)([А-ЯЁ])", r"\1 \2"), (r"\s+", " "),
]

_FRAGMENTS = st.sampled_from([
    "<b>", "</b>", "<", ">", "#", "#тег", "@", "@кто", "a@b.ru", "http://", "https://x.y/z", "www.", "www.a", "/", ".", "!",
    "Да", "нет", "Ё", " ", "\n", "\t", " ", " ", "&nbsp;", "x" * 24, "-_9", "😀", "漢", "​", ":", "é", "1", "\x1c"])


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(_FRAGMENTS, max_size=12).map("".join), min_size=20, max_size=60))
def test_clean_text_agrees_with_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = T.clean_column(df, "t", "c").select("t", "c").collect()
    assert [r["c"] for r in got] == [_apply(CLEAN_STEPS, r["t"]) for r in got]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=30, max_size=60))
def test_words_and_tokens_agree_with_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", T.word_count("t").alias("n"), T.tokens("t").alias("w"), T.squeeze("t").alias("s")).collect()
    for r in got:
        assert r["w"] == r["t"].split()
        assert r["s"] == re.sub(r"\s+", " ", r["t"]).strip()
    # Unicode versions may differ on rare code points; assigned common ones must agree
    common = [r for r in got if all(ord(c) < 0x2000 for c in r["t"])]
    assert sum(r["n"] for r in common) == sum(len(re.findall(r"\b\w+\b", r["t"])) for r in common)


def test_word_count(values):
    assert values(T.word_count, ["Привет, мир-раз 5", "", None, "a_b c"]) == [4, 0, 1, 2]


def test_terms_have_two_characters(values):
    assert values(T.terms, ["Я ДА, on a и-он"]) == [["да", "on", "он"]]


def test_sentences(values):
    assert values(T.sentences, ["Раз. Два!  Три?\nЧетыре… пять 3.5", "", None, "  один  "]) == [
        ["Раз.", "Два!", "Три?", "Четыре…", "пять 3.5"], [], [], ["один"]]


def test_drop_words_keeps_repeats_and_case(values):
    assert values(lambda v: T.drop_words(v, ["и"]), ["раз и  раз И два"]) == ["раз раз И два"]
    assert values(lambda v: T.drop_words(v, []), [" a  b "]) == ["a b"]


def test_keep_alphabet_inserts_no_blank(values):
    assert values(T.keep_alphabet, ["ко-т cat 3.5  ёж ЇЁ!"]) == ["кот 3.5 ёж Ё"]
    assert values(lambda v: T.keep_alphabet(v, "a-z"), ["кот cat"]) == ["cat"]


# fixed values: the punctuation steps, in order
TIDY_STEPS = [
    (r"[^а-яА-ЯёЁa-zA-Z0-9\s.:]", " "), (r"\s+\.(?=\S)", "."), (r"(?<=\D)\s+\.(?=\D)", "."),
    (r"(?<!\d)\.|[^\w\s.]|(?<!\d)\.(?!\d)", ""), (r"\s+", " "),
]


def _apply(steps, text):
    for pattern, replacement in steps:
        text = re.sub(pattern, replacement, text)
    return text.strip()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("аЯё zA19.:,-  \n№", max_size=25), min_size=30, max_size=60))
def test_tidy_and_letters_agree_with_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", T.tidy_punctuation("t").alias("p"), T.letters_only("t").alias("l")).collect():
        assert r["p"] == _apply(TIDY_STEPS, r["t"])
        assert r["l"] == re.sub(r"[^а-яА-ЯёЁa-zA-Z]+", " ", r["t"]).strip(" ")


def test_letters_only_rejects_other_cyrillic(values):
    assert values(T.letters_only, ["їжак ёж"]) == ["жак ёж"]


@pytest.mark.parametrize("options, expected", [
    (dict(method="findall"), ["1", "22", "1"]),
    (dict(method="finditer", unique=True), ["1", "22"]),
    (dict(method="search"), ["1"]),
    (dict(method="fullmatch"), []),
    (dict(method="fullmatch", when_none="x"), ["x"]),
    (dict(method="findall", as_float=True), [1.0, 22.0, 1.0]),
    (dict(method="findall", pick=1), ["22"]),
    (dict(method="findall", pick=[0, 2, 9]), ["1", "1"]),
    (dict(method="findall", as_list=False), "1 + 22 + 1"),
    (dict(method="findall", as_list=False, border="|", separator=","), "|1,22,1|"),
    (dict(method="findall", as_list=False, when_many="many"), "many"),
    (dict(method="findall", as_list=False, pick=1), "22"),
    (dict(method="findall", as_list=False, pick=-1), "1"),
    (dict(method="search", as_list=False, as_float=True), 1.0),
    (dict(method="search", as_list=False, when_one="one"), "one"),
    (dict(method="fullmatch", as_list=False), "0"),
    (dict(method="fullmatch", as_list=False, as_float=True), 0.0),
    (dict(method="split"), ["a", "b", "c", "d"]),
    (dict(method="sub", replacement="$"), "a$b$c$d"),
])
def test_apply_regex(values, options, expected):
    assert values(lambda v: apply_regex(v, r"[0-9]+", **options), ["a1b22c1d"]) == [expected]


def test_apply_regex_groups_flags_and_unknown_method(values):
    assert values(lambda v: apply_regex(v, r"(\w)(\d)", replacement=r"\2\1"), ["a1 b2"]) == ["1a 2b"]
    assert values(lambda v: apply_regex(v, "ПРИВЕТ", "search", flags="iu"), ["привет"]) == [["привет"]]
    with pytest.warns(UserWarning):
        assert values(lambda v: apply_regex(v, "a", "nope"), ["a"]) == [None]


def test_cleaning_runs_once_below_a_filter(spark):
    """A filter on the cleaned text must not copy the cleaning patterns into itself."""
    df = spark.createDataFrame([("a",)], "t string").where("t <> ''")
    cleaned = T.clean_column(df, "t", "c").where(T.word_count("c") >= 1)
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("A-Za-z0-9_-]{25,}") == 1


def test_patterns_of_spaces_match_python():
    assert set(P.SPACE_CHARS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_array_members_are_dropped(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["b"]), (["a"], None)], "x array<string>, u array<string>")
    assert [r[0] for r in df.select(T.drop_members(F.col("x"), F.col("u"))).collect()] == ["a a", "a"]
