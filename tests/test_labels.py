import math
import random
import time

import pytest
from pyspark.sql import functions as F

from corpusops.functions import scores as S
from corpusops.functions.literals import required_literals
from corpusops.operators import metrics as M
from corpusops.operators import rules as R
from corpusops.plans.classify import classify_frame
from corpusops.session import stage


def scored(spark, pairs, group="g"):
    return spark.createDataFrame([(group, float(s), y) for s, y in pairs], "part string, predicted_probability double, true_label int")


@pytest.mark.parametrize("pairs, area", [
    ([(0.9, 0), (0.8, 1), (0.7, 0), (0.6, 1)], 0.333333),
    ([(0.9, 1), (0.9, 0), (0.5, 1)], 0.666667),
    ([(0.9, 1), (0.1, 0)], 1.0),
    ([(0.5, 1), (0.5, 0)], 0.75),
])
def test_pr_auc(spark, pairs, area):
    got = M.score_auc(scored(spark, pairs), ["part"]).first()
    assert round(got["pr_auc_score"], 6) == area
    assert 0 <= got["pr_auc_score"] <= 1


def test_pr_auc_undefined_and_per_group(spark):
    df = scored(spark, [(0.9, 0)]).union(scored(spark, [(0.9, 1), (0.1, 0)], "h"))
    got = {r["part"]: r for r in M.score_auc(df, ["part"]).collect()}
    assert got["g"]["pr_auc_score"] is None and got["g"]["roc_auc_score"] is None
    assert got["h"]["pr_auc_score"] == 1.0 and got["h"]["roc_auc_score"] == 1.0


def test_curve_over_many_ranges_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "RANGE_SCORES", 100)
    pairs = [((i * 7919 % 5003) / 5003, 1 if (i * 31) % 7 < 3 else 0) for i in range(5003)]
    got = {r["score"]: (r["tp"], r["fp"]) for r in M.pr_curve(scored(spark, pairs), []).collect()}
    tp = fp = 0
    area, recall0, precision0 = 0.0, 0.0, 1.0
    positives = sum(y for _, y in pairs)
    for score, y in sorted(pairs, reverse=True):
        tp, fp = tp + y, fp + 1 - y
        assert got[score] == (tp, fp)
        area += (tp / positives - recall0) * (tp / (tp + fp) + precision0) / 2
        recall0, precision0 = tp / positives, tp / (tp + fp)
    assert M.score_auc(scored(spark, pairs), []).first()["pr_auc_score"] == pytest.approx(area)


def test_ranges_follow_the_number_of_distinct_scores(spark, monkeypatch):
    """A million scores of one group: no range has more than a few times the rows that one is meant to have."""
    written = {}
    monkeypatch.setattr(M, "stage", lambda df, name: written.setdefault(name, stage(df, name)))
    many = spark.range(1_000_000).select(((F.col("id") * 7919) % 1_000_003 / 1_000_003).alias("predicted_probability"), (F.col("id") % 2).cast("int").alias("true_label"))
    area = M.score_auc(many, []).first()["roc_auc_score"]
    sizes = [r[1] for r in written["score-ranges"].groupBy("__cell").count().collect()]
    assert sum(sizes) == 1_000_000 and len(sizes) > 10 and max(sizes) < 3 * M.RANGE_SCORES
    assert area == pytest.approx(0.5, abs=0.01)


def test_confusion_of_one_class(spark):
    df = spark.createDataFrame([(1, 1)] * 3, "true_label int, predicted_label int")
    row = M.hard_label_auc(M.label_metrics(M.confusion(df, []))).first()
    cells = [row[f"{a}_predicted_{b}"] for a, b in (("true", "negative"), ("false", "positive"), ("false", "negative"), ("true", "positive"))]
    assert cells == [0, 0, 0, 3]
    assert (row["accuracy"], row["precision"], row["recall"], row["f1_score"], row["roc_auc_hard"]) == (1, 1, 1, 1, None)


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([(0, 0)], "true_label int, predicted_label int")
    row = M.label_metrics(M.confusion(df, [])).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1_score"]) == (1, 0, 0, 0)
    with pytest.raises(ValueError):
        M.confusion(df.drop("true_label"), [])


def test_upsert_and_rounding(spark):
    kind = "model_name string, data_type string, f1 double"
    old = spark.createDataFrame([("m1", "train", 0.5), ("m1", "dev", 0.4)], kind)
    new = spark.createDataFrame([("m1", "dev", 0.6)], kind)
    assert sorted(tuple(r) for r in M.upsert_metrics(old, new).collect()) == [("m1", "dev", 0.6), ("m1", "train", 0.5)]
    assert M.rounded(spark.createDataFrame([(0.126, 3)], "a double, b int")).first() == (0.13, 3)


def test_fold_summary_uses_population_deviation(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0)], "size int, loss double")
    assert tuple(M.fold_summary(df, ["size"], "loss").first()) == (1, 2.0, 1.0)


RULES = [r"задержа\w+", r"(?i)СУД\b", r"(штраф).*\1"]


@pytest.mark.parametrize("text, hit", [
    ("его задержали", 1), ("идет суд", 1), ("судья", 0), ("штраф и штраф", 1), ("штраф", 0), ("", 0), (None, 0), ("Задержали", 0)])
def test_rules(spark, text, hit):
    df = spark.createDataFrame([(text,)], "content string")
    assert tuple(R.classify(df, RULES).first())[1:] == (1, hit)
    assert tuple(R.classify(df, RULES, label_type="negative").first())[1:] == (0, hit)
    assert tuple(R.classify(df, RULES, label_type="negative", invert_negative=True).first())[1:] == (0, 1 - hit)


def test_many_rules_stay_one_scan(spark):
    rules = [f"слово{i}\\b" for i in range(2000)]
    df = spark.createDataFrame([("вот слово1999 тут",), ("слово2000",)], "content string")
    matched = R.texts_matching(df, rules)
    assert [r[0] for r in matched.collect()] == ["вот слово1999 тут"]
    assert "Join" not in matched._jdf.queryExecution().executedPlan().toString()
    assert R.texts_matching(df, []).count() == 0


def test_classification_plan(spark):
    rows = [("суд", "own", "2024-06-02"), ("суд " * 7, None, "2024-06-02T10:00:00+03:00"), ("мир " * 7, "b", "2024-06-02"),
            ("суд " * 8, "b", "2024-05-01"), (None, "b", "2024-06-02"), ("суд " * 9, "b", "bad")]
    df = spark.createDataFrame(rows, "content string, channel string, date string")
    classified, metrics = classify_frame(df, RULES, "n", exclude_like="OWN")
    assert classified.count() == 3 and metrics.first()["true_predicted_positive"] == 2
    filtered, _ = classify_frame(df, RULES, "n", filtered=True, start="2024-06-01", label_type="negative")
    assert sorted(r["predicted_label"] for r in filtered.collect()) == [0, 1]


LOGS = "top_logprobs array<struct<token:string,logprob:double>>, prompt_tokens long"


@pytest.mark.parametrize("entries, default, legacy", [
    ([("1", -0.1), ("0", -2.3)], 0.900250, 0.900250),
    ([("0", 0.0)], 0.0, 0.5),
    ([("1", -0.2)], 1.0, math.exp(-0.2) / (math.exp(-0.2) + 1)),
    ([("x", -0.2)], None, 0.5),
    ([("1", -900.0), ("0", -901.0)], 0.731059, 0.731059),
    ([("1", -5.0), ("1", -0.1), ("0", -2.3)], 0.900250, 0.900250),
])
def test_label_probability(spark, entries, default, legacy):
    df = spark.createDataFrame([(entries, 12)], LOGS)
    row, old = S.score_responses(df).first(), S.score_responses(df, legacy_missing=True).first()
    assert row["probability"] == (None if default is None else pytest.approx(default, abs=1e-6))
    assert old["probability"] == pytest.approx(legacy, abs=1e-6)
    assert row["num_tokens"] == 12


def test_prompt_and_sigmoid(spark):
    df = spark.createDataFrame([("текст", 0.0)], "t string, x double")
    messages = df.select(S.prompt_messages("t")).first()[0]
    assert [m["role"] for m in messages] == ["system", "user"] and messages[1]["content"] == "News text: текст"
    assert df.select(S.sigmoid("x")).first()[0] == 0.5
    assert df.select(S.sigmoid(F.lit(-1000.0))).first()[0] == 0.0


LITERALS = [
    ("abcd", ["abcd"], False), ("(?i)Привет", ["привет"], True), (r"\bслово\b", ["слово"], False), (r"ab+cdef?", ["cde"], False), ("(abc|defg)x?", ["abc", "defg"], False),
    (r"a(?:bcd)?efgh", ["efgh"], False), (r"(abc)+", ["abc"], False), (r"[a-z]+word\d", ["word"], False), (r"1\.25\$", ["1.25$"], False), (r"x{2}longer", ["longer"], False),
    (r"(?=abc)wxyz(?!q)", ["wxyz"], False), (r"\p{L}+ness", ["ness"], False), ("[[a]b]text", ["text"], False),
]


@pytest.mark.parametrize("rule, words, ignore", LITERALS)
def test_required_literals(rule, words, ignore):
    assert required_literals(rule) == (words, ignore)


@pytest.mark.parametrize("rule", ["ab", "a?b?c?", r"\d+", "abc|", "abc|x", "(?x)a b c", r"\Qabc\E", r"\x41bcd", "(?i:abcd)", "(abcd", "a**", "(?<n>ab)\\k<n>"])
def test_no_literal_is_claimed_where_none_is_known(rule):
    assert required_literals(rule) is None


def test_many_rules_label_like_the_plain_scan(spark):
    pick = random.Random(8)
    parts = ["суд", "Закон", "дело", "abc", "де", "x", r"\d+", r"\s", ".", "[а-я]", "(?:раз|два|трижды)", "конец?", "K", "ſtart", "İ", "ı"]
    rules = [pick.choice(["", "(?i)"]) + "".join(pick.choice(parts) + pick.choice(["", "", "", "?", "+", "{2}", "{0,1}"]) for _ in range(pick.randint(1, 5))) for _ in range(300)]
    rules += [r"(суд)\1", r"(?<a>дело)x", "дело|"[:-1]]
    words = ["суд", "СУД", "закон", "Закон", "делодело", "abc", "ABC", "де", "12", "раз", "трижды", "конец", "коне", "k", "K", "start", "ſTART", "i", "İ", "ı", " ", "x"]
    texts = ["".join(pick.choice(words) for _ in range(pick.randint(0, 8))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    hits = df.select("k", *[F.struct(R.matches_any("t", [r]).alias("p"), R.matches_any("t", [r], few=0).alias("f")).alias(f"r{i}") for i, r in enumerate(rules[:60])])
    for row in hits.collect():
        assert all(row[f"r{i}"]["p"] == row[f"r{i}"]["f"] for i in range(60)), row
    plain = {r.k: r.m for r in df.select("k", R.matches_any("t", rules, few=10_000).alias("m")).collect()}
    quick = {r.k: r.m for r in df.select("k", R.matches_any("t", rules, few=0).alias("m")).collect()}
    assert plain == quick


def test_time_hardly_depends_on_the_number_of_rules(spark):
    df = spark.createDataFrame([("слово за словом и номер 77 тут " * 40,)] * 400, "content string")

    def seconds(n):
        rules = [rf"(?i)номер {i}[а-я]? из \d+" for i in range(n)] + ["номер 77"]
        start = time.time()
        assert R.texts_matching(df, rules).count() == 400
        return time.time() - start

    seconds(200)
    assert seconds(10_000) < 10 * seconds(200) + 5
