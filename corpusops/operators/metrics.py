"""Classification metrics as aggregations over a table of labels, predictions and scores."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .frames import require

#: distinct scores of a range, about
RANGE_SCORES = 50_000


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def class_counts(df: DataFrame, by: list[str], label: str = "true_label") -> DataFrame:
    return df.groupBy(*by).agg(
        F.count("*").alias("total_data"),
        F.count_if(F.col(label) == 1).alias("true_positive_news"),
        F.count_if(F.col(label) == 0).alias("true_negative_news"),
    )


def confusion(
    df: DataFrame, by: list[str], label: str = "true_label", predicted: str = "predicted_label"
) -> DataFrame:
    """Row and class counts and the four cells of the confusion matrix per group, always all four."""
    require(df, label, predicted)
    y, p = F.col(label), F.col(predicted)
    return df.groupBy(*by).agg(
        F.count("*").alias("total_data"),
        F.count_if(y == 1).alias("true_positive_news"),
        F.count_if(y == 0).alias("true_negative_news"),
        F.count_if((y == 0) & (p == 0)).alias("true_predicted_negative"),
        F.count_if((y == 0) & (p == 1)).alias("false_predicted_positive"),
        F.count_if((y == 1) & (p == 0)).alias("false_predicted_negative"),
        F.count_if((y == 1) & (p == 1)).alias("true_predicted_positive"),
    )


def label_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from confusion counts; 0 where undefined."""
    tn, fp = F.col("true_predicted_negative"), F.col("false_predicted_positive")
    fn, tp = F.col("false_predicted_negative"), F.col("true_predicted_positive")
    return counts.withColumns({
        "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
    })


def hard_label_auc(counts: DataFrame) -> DataFrame:
    """ROC AUC of the 0/1 predictions: mean of the true positive and true negative rate."""
    tpr = F.try_divide(F.col("true_predicted_positive"), F.col("true_predicted_positive") + F.col("false_predicted_negative"))
    tnr = F.try_divide(F.col("true_predicted_negative"), F.col("true_predicted_negative") + F.col("false_predicted_positive"))
    return counts.withColumn("roc_auc_hard", (tpr + tnr) / 2)


def _grouped(df: DataFrame, by: list[str]) -> tuple[DataFrame, list[str]]:
    """Group columns, a constant one if there are none."""
    return (df, by) if by else (df.withColumn("__all", F.lit(0)), ["__all"])


def _same_group(by: list[str], other: list[str]) -> Column:
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(by, other)])


def _curve(df: DataFrame, by: list[str], label: str, score: str) -> DataFrame:
    """Per group and distinct score the label counts at it (pos, neg), above or at it (tp, fp) and
    in the whole group (all_pos, all_neg).

    The input is read once; what is written are the counts of its distinct scores. They are laid out by group and falling score in as many
    ranges as their number asks for; running sums are taken inside the ranges, whose totals are then summed up in turn, so
    no task sees all scores of a group.
    """
    at_score = (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    at_score = stage(at_score, "scores")
    ranges = max(1, -(-at_score.count() // RANGE_SCORES))
    ranged = at_score.repartitionByRange(ranges, *[F.asc_nulls_first(b) for b in by], F.col("score").desc())
    cells = stage(ranged.withColumn("__cell", F.spark_partition_id()), "score-ranges")
    inside = Window.partitionBy(*by, "__cell").orderBy(F.col("score").desc())
    # one row per score range from here on
    group = Window.partitionBy(*by)
    above = group.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"__by{i}" for i in range(len(by))]
    totals = (
        cells.groupBy(*by, "__cell").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(*[F.col(b).alias(a) for a, b in zip(names, by)], F.col("__cell").alias("__c"),
                F.coalesce(F.sum("p").over(above), F.lit(0)).alias("__p"),
                F.coalesce(F.sum("n").over(above), F.lit(0)).alias("__n"),
                F.sum("p").over(group).alias("all_pos"), F.sum("n").over(group).alias("all_neg"))
    )
    running = cells.withColumns({"__tp": F.sum("pos").over(inside), "__fp": F.sum("neg").over(inside)})
    return running.join(totals, (F.col("__cell") == F.col("__c")) & _same_group(by, names)).select(
        *by, "score", "pos", "neg",
        (F.col("__tp") + F.col("__p")).alias("tp"), (F.col("__fp") + F.col("__n")).alias("fp"),
        "all_pos", "all_neg")


def pr_curve(
    df: DataFrame, by: list[str], label: str = "true_label", score: str = "predicted_probability"
) -> DataFrame:
    """Precision and recall at every distinct score: (group, score, tp, fp, precision, recall).

    Recall is null in a group without positives. The closing point (recall 0, precision 1) has no
    score and is not part of the table.
    """
    df, groups = _grouped(df, by)
    return _curve(df, groups, label, score).select(
        *by, "score", "tp", "fp",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp"), F.col("all_pos")).alias("recall"),
    )


def score_auc(
    df: DataFrame, by: list[str], label: str = "true_label", score: str = "predicted_probability"
) -> DataFrame:
    """Areas under the precision-recall and the ROC curve of the scores, by trapezoids.

    The precision-recall curve starts at (recall 0, precision 1). Null without positives (and for
    ROC without negatives).
    """
    df, groups = _grouped(df, by)
    tp, fp = F.col("tp"), F.col("fp")
    # the previous point of the curve is this one without the rows at this score
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    precision = tp / (tp + fp)
    precision0 = F.coalesce(F.try_divide(tp0, tp0 + fp0), F.lit(1.0))
    recall_step = F.try_divide(F.col("pos"), F.col("all_pos"))
    fpr_step = F.try_divide(F.col("neg"), F.col("all_neg"))
    areas = _curve(df, groups, label, score).groupBy(*groups).agg(
        F.sum(recall_step * (precision + precision0) / 2).alias("pr_auc_score"),
        F.sum(fpr_step * F.try_divide(tp + tp0, 2 * F.col("all_pos"))).alias("roc_auc_score"),
    )
    return areas.select(*by, "pr_auc_score", "roc_auc_score")


def evaluate(
    df: DataFrame,
    by: list[str],
    label: str = "true_label",
    predicted: str = "predicted_label",
    score: str | None = "predicted_probability",
) -> DataFrame:
    """All metrics per group (split or data set) in one table; score areas only if there is a score."""
    df, groups = _grouped(df, by)
    result = hard_label_auc(label_metrics(confusion(df, groups, label, predicted)))
    if score is not None:
        names = [f"__by{i}" for i in range(len(groups))]
        areas = score_auc(df, groups, label, score).withColumnsRenamed(dict(zip(groups, names)))
        result = result.join(areas, _same_group(groups, names), "left").drop(*names)
    return result if by else result.drop(*groups)


def log_loss(
    df: DataFrame, by: list[str], label: str = "true_label", score: str = "predicted_probability", eps: float = 1e-15
) -> DataFrame:
    p = F.greatest(F.least(F.col(score), F.lit(1 - eps)), F.lit(eps))
    loss = -F.when(F.col(label) == 1, F.ln(p)).otherwise(F.ln(1 - p))
    return df.groupBy(*by).agg(F.avg(loss).alias("log_loss"))


def fold_summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean and population standard deviation of a value over folds."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def upsert_metrics(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("model_name", "data_type")) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same key."""
    return old.join(new, list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def rounded(df: DataFrame, places: int = 2) -> DataFrame:
    """Round all double columns, as the metric files hold them."""
    doubles = [c for c, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.round(c, places) for c in doubles})
