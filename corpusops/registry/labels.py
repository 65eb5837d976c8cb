"""Queries of the rule classifier, the metrics and the label probabilities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scores as S
from ..operators import metrics as M
from ..operators import rules as R
from ..plans.classify import classify_frame
from .base import NEWS, SCORED, documents, news, query, scored, table

# the patterns must mean the same in the oracle's dialect
_RULES = [r"(?i)\bthe \w+ing\b", r"[0-9]{3,}", r"(?i)bonjour|être", r"#\S+", r"und der (\w+) und", r"^Is "]
_ANY_SQL = " OR ".join(f"regexp_matches(text, '{r}')" for r in _RULES)
_COUNTS_SQL = """count(*) AS total_data, count(*) FILTER (true_label = 1) AS true_positive_news, count(*) FILTER (true_label = 0) AS true_negative_news,
  count(*) FILTER (true_label = 0 AND predicted_label = 0) AS true_predicted_negative, count(*) FILTER (true_label = 0 AND predicted_label = 1) AS false_predicted_positive,
  count(*) FILTER (true_label = 1 AND predicted_label = 0) AS false_predicted_negative, count(*) FILTER (true_label = 1 AND predicted_label = 1) AS true_predicted_positive"""
_RATIOS_SQL = """coalesce((true_predicted_positive + true_predicted_negative) / nullif(total_data, 0), 0) AS accuracy,
  coalesce(true_predicted_positive / nullif(true_predicted_positive + false_predicted_positive, 0), 0) AS "precision",
  coalesce(true_predicted_positive / nullif(true_predicted_positive + false_predicted_negative, 0), 0) AS recall,
  coalesce(2 * true_predicted_positive / nullif(2 * true_predicted_positive + false_predicted_positive + false_predicted_negative, 0), 0) AS f1_score,
  (true_predicted_positive / nullif(true_predicted_positive + false_predicted_negative, 0)
   + true_predicted_negative / nullif(true_predicted_negative + false_predicted_positive, 0)) / 2 AS roc_auc_hard"""
_RATIOS = ["accuracy", "precision", "recall", "f1_score", "roc_auc_hard"]
_ROUND_SQL = ", ".join(f'round("{c}", 6) AS "{c}"' for c in _RATIOS)
_CELLS = ["total_data", "true_positive_news", "true_negative_news", "true_predicted_negative", "false_predicted_positive",
          "false_predicted_negative", "true_predicted_positive"]


@query(f"SELECT doc_id, 0 AS true_label, CASE WHEN {_ANY_SQL} THEN 1 ELSE 0 END AS predicted_label FROM documents")
def rule_classify(spark, sf_dir):
    return R.classify(documents(spark, sf_dir), _RULES, "text", "negative").select("doc_id", "true_label", "predicted_label")


@query(f"SELECT doc_id, 0 AS true_label, CASE WHEN {_ANY_SQL} THEN 0 ELSE 1 END AS predicted_label FROM documents")
def rule_classify_inverted(spark, sf_dir):
    return R.classify(documents(spark, sf_dir), _RULES, "text", "negative", invert_negative=True).select("doc_id", "true_label", "predicted_label")


@query(f"SELECT doc_id, source FROM documents WHERE {_ANY_SQL}")
def rule_hits(spark, sf_dir):
    return R.texts_matching(documents(spark, sf_dir), _RULES, "text").select("doc_id", "source")


@query(f"""WITH {NEWS}, k AS (SELECT 1 AS true_label, CASE WHEN {_ANY_SQL.replace('(text,', '(content,')} THEN 1 ELSE 0 END AS predicted_label FROM news
  WHERE date >= TIMESTAMP '2024-06-01' AND len(regexp_extract_all(content, '[\\p{{L}}\\p{{N}}_]+')) >= 7 AND NOT contains(lower(channel), 'src7')),
c AS (SELECT {_COUNTS_SQL} FROM k), m AS (SELECT *, {_RATIOS_SQL} FROM c)
SELECT 'from_june' AS df_name, {', '.join(_CELLS)}, {_ROUND_SQL} FROM m""")
def rule_classification_report(spark, sf_dir):
    _, metrics = classify_frame(news(spark, sf_dir), _RULES, "from_june", exclude_like="src7", filtered=True, start="2024-06-01")
    return M.rounded(metrics, 6)


@query(f"WITH {SCORED} SELECT data_type, count(*) AS total_data, count(*) FILTER (true_label = 1) AS true_positive_news, count(*) FILTER (true_label = 0) AS true_negative_news FROM scored GROUP BY data_type")
def class_counts(spark, sf_dir):
    return M.class_counts(scored(spark, sf_dir), ["data_type"])


@query(f"WITH {SCORED} SELECT data_type, {_COUNTS_SQL} FROM scored GROUP BY data_type")
def confusion_by_split(spark, sf_dir):
    return M.confusion(scored(spark, sf_dir), ["data_type"])


@query(f"WITH {SCORED}, c AS (SELECT data_type, {_COUNTS_SQL} FROM scored GROUP BY data_type), m AS (SELECT *, {_RATIOS_SQL} FROM c) SELECT data_type, {', '.join(_CELLS)}, {_ROUND_SQL} FROM m")
def classification_metrics(spark, sf_dir):
    return M.rounded(M.evaluate(scored(spark, sf_dir), ["data_type"], score=None), 6)


@query(f"WITH {SCORED}, c AS (SELECT {_COUNTS_SQL} FROM scored), m AS (SELECT *, {_RATIOS_SQL} FROM c) SELECT round(roc_auc_hard, 6) AS roc_auc_hard FROM m")
def hard_label_auc(spark, sf_dir):
    return M.rounded(M.hard_label_auc(M.confusion(scored(spark, sf_dir), [])).select("roc_auc_hard"), 6)


@query(f"WITH {SCORED}, c AS (SELECT data_type, {_COUNTS_SQL} FROM scored GROUP BY data_type), m AS (SELECT *, {_RATIOS_SQL} FROM c) SELECT data_type, {', '.join(_CELLS)}, {_ROUND_SQL.replace(', 6)', ', 2)')} FROM m")
def metrics_rounded(spark, sf_dir):
    return M.rounded(M.evaluate(scored(spark, sf_dir), ["data_type"], score=None))


_CURVE_SQL = f"""{SCORED}, a AS (SELECT data_type, predicted_probability AS score, count(*) FILTER (true_label = 1) AS pos, count(*) FILTER (true_label = 0) AS neg FROM scored GROUP BY 1, 2),
b AS (SELECT *, CAST(sum(pos) OVER u AS BIGINT) AS tp, CAST(sum(neg) OVER u AS BIGINT) AS fp, sum(pos) OVER (PARTITION BY data_type) AS all_pos, sum(neg) OVER (PARTITION BY data_type) AS all_neg
  FROM a WINDOW u AS (PARTITION BY data_type ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
curve AS (SELECT *, tp / (tp + fp) AS "precision", tp / nullif(all_pos, 0) AS recall, fp / nullif(all_neg, 0) AS fpr FROM b)"""


@query(f'WITH {_CURVE_SQL} SELECT data_type, round(score, 6) AS score, tp, fp, round("precision", 6) AS "precision", round(recall, 6) AS recall FROM curve')
def pr_curve(spark, sf_dir):
    return M.rounded(M.pr_curve(scored(spark, sf_dir), ["data_type"]), 6)


@query(f"""WITH {_CURVE_SQL}, l AS (SELECT *, lag(recall, 1, 0) OVER w AS r0, lag("precision", 1, 1) OVER w AS p0, lag(fpr, 1, 0) OVER w AS f0 FROM curve WINDOW w AS (PARTITION BY data_type ORDER BY score DESC))
SELECT data_type, round(sum((recall - r0) * ("precision" + p0) / 2), 6) AS pr_auc_score, round(sum((fpr - f0) * (recall + r0) / 2), 6) AS roc_auc_score FROM l GROUP BY data_type""")
def pr_auc(spark, sf_dir):
    return M.rounded(M.score_auc(scored(spark, sf_dir), ["data_type"]), 6)


@query(f"""WITH {SCORED}, p AS (SELECT data_type, doc_id % 5 AS fold, avg(predicted_probability) AS score FROM scored GROUP BY 1, 2)
SELECT data_type, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std FROM p GROUP BY data_type""")
def fold_mean_std(spark, sf_dir):
    folds = scored(spark, sf_dir).groupBy("data_type", (F.col("doc_id") % 5).alias("fold")).agg(F.avg("predicted_probability").alias("score"))
    return M.rounded(M.fold_summary(folds, ["data_type"], "score"), 6)


@query(f"""WITH {SCORED}, p AS (SELECT data_type, true_label, greatest(least(predicted_probability, 1 - 1e-15), 1e-15) AS p FROM scored)
SELECT data_type, round(avg(CASE WHEN true_label = 1 THEN -ln(p) ELSE -ln(1 - p) END), 6) AS log_loss FROM p GROUP BY data_type""")
def log_loss(spark, sf_dir):
    return M.rounded(M.log_loss(scored(spark, sf_dir), ["data_type"]), 6)


@query(f"""WITH {SCORED}, o AS (SELECT data_type, count(*) AS total_data FROM scored GROUP BY data_type),
n AS (SELECT data_type, -count(*) AS total_data FROM scored WHERE true_label = 1 AND data_type <> 'fr' GROUP BY data_type)
SELECT 'm1' AS model_name, data_type, total_data FROM n UNION ALL SELECT 'm1', data_type, total_data FROM o WHERE data_type NOT IN (SELECT data_type FROM n)""")
def metrics_upsert(spark, sf_dir):
    rows = scored(spark, sf_dir).withColumn("model_name", F.lit("m1"))
    old = rows.groupBy("model_name", "data_type").agg(F.count("*").alias("total_data"))
    new = rows.where("true_label = 1 AND data_type <> 'fr'").groupBy("model_name", "data_type").agg((-F.count("*")).alias("total_data"))
    return M.upsert_metrics(old, new)


@query("SELECT event_id, round(1 / (1 + exp(-value / 10)), 6) AS probability FROM events")
def sigmoid(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(S.sigmoid(F.col("value") / 10), 6).alias("probability"))


@query("""SELECT conv_id, turn, 'system' AS first_role, 'You are a helpful classification assistant. Your task is to read the given news text in Russian and provide the classification label (''0'' or ''1'').' AS first_content,
  'user' AS second_role, 'News text: ' || text AS second_content FROM conversations""")
def prompt_messages(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", S.prompt_messages("text").alias("m"))
    return turns.select("conv_id", "turn", F.col("m")[0]["role"].alias("first_role"), F.col("m")[0]["content"].alias("first_content"),
                        F.col("m")[1]["role"].alias("second_role"), F.col("m")[1]["content"].alias("second_content"))


# stored responses: log-probabilities from the text length; '1' missing in every 5th, '0' in every 7th
_LOGS = """logs AS (SELECT doc_id, n_chars AS num_tokens, CASE WHEN doc_id % 5 > 0 THEN -(n_chars % 97) / 10.0::DOUBLE END AS one, CASE WHEN doc_id % 7 > 0 THEN -(n_chars % 89) / 10.0::DOUBLE END AS zero FROM documents)"""


def _responses(spark, sf_dir):
    def entry(token, value, keep):
        item = F.struct(F.lit(token).alias("token"), value.cast("double").alias("logprob"))
        return F.when(keep, F.array(item)).otherwise(F.array().cast("array<struct<token:string,logprob:double>>"))
    d, n = F.col("doc_id"), F.col("n_chars")
    entries = F.concat(entry("x", F.lit(-3.0), d >= 0), entry("1", -(n % 97) / 10.0, d % 5 > 0), entry("0", -(n % 89) / 10.0, d % 7 > 0))
    return table(spark, sf_dir, "documents").select("doc_id", entries.alias("top_logprobs"), n.alias("prompt_tokens"))


_SOFTMAX = "exp({a}) / (exp({a}) + exp({b}))"


@query(f"""WITH {_LOGS} SELECT doc_id, num_tokens, zero AS token_0_logprob, one AS token_1_logprob, round(CASE WHEN one IS NULL AND zero IS NULL THEN NULL WHEN one IS NULL THEN 0 WHEN zero IS NULL THEN 1
  ELSE {_SOFTMAX.format(a='one', b='zero')} END, 6) AS probability FROM logs""")
def two_class_probability(spark, sf_dir):
    return S.score_responses(_responses(spark, sf_dir)).withColumn("probability", F.round("probability", 6))


@query(f"""WITH {_LOGS} SELECT doc_id, num_tokens, zero AS token_0_logprob, one AS token_1_logprob,
  round({_SOFTMAX.format(a='coalesce(one, 0)', b='coalesce(zero, 0)')}, 6) AS probability FROM logs""")
def two_class_probability_legacy(spark, sf_dir):
    return S.score_responses(_responses(spark, sf_dir), legacy_missing=True).withColumn("probability", F.round("probability", 6))
