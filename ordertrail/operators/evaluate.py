"""Evaluation of scored rows: ROC, area under it, confusion counts and the per-class report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running_totals


def _ranked_scores(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score the positives and negatives, those with a lower score, and those of all."""
    counted = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    return running_totals(counted, ["score"], ["pos", "neg"])


def roc_auc(df: DataFrame, score: str = "churn_probability", label: str = "churned") -> DataFrame:
    """Area under the ROC curve: the share of (positive, negative) pairs ranked right, ties counting
    half. NULL if a class is empty."""
    won = F.col("pos") * (F.col("before_neg") + F.col("neg") / F.lit(2.0))
    pairs = F.first("all_pos") * F.first("all_neg").cast("double")
    return _ranked_scores(df, score, label).agg((F.sum(won) / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def roc_curve(df: DataFrame, score: str = "churn_probability", label: str = "churned") -> DataFrame:
    """One point per distinct score, as a threshold: the rates among rows that reach it. The curve's
    start, where nothing does, has a NULL threshold."""
    ranked = _ranked_scores(df, score, label)
    all_pos, all_neg = F.col("all_pos").cast("double"), F.col("all_neg").cast("double")
    points = ranked.select(
        F.col("score").alias("threshold"),
        ((F.col("all_neg") - F.col("before_neg")) / F.nullif(all_neg, F.lit(0.0))).alias("fpr"),
        ((F.col("all_pos") - F.col("before_pos")) / F.nullif(all_pos, F.lit(0.0))).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast(points.schema["threshold"].dataType).alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def confusion_matrix(df: DataFrame, prediction: str = "churn_prediction", label: str = "churned") -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("rows"))


def classification_report(df: DataFrame, prediction: str = "churn_prediction", label: str = "churned") -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means; 0/0 is 0."""
    def cell(actual: int, predicted: int) -> Column:
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted)).cast("double")

    n = df.agg(*[cell(a, p).alias(f"n{a}{p}") for a in (0, 1) for p in (0, 1)])

    def safe(num: Column, den: Column) -> Column:
        return F.when(den == 0, F.lit(0.0)).otherwise(num / F.nullif(den, F.lit(0.0)))

    def measures(c: int) -> Column:
        hit, other = F.col(f"n{c}{c}"), 1 - c
        precision = safe(hit, hit + F.col(f"n{other}{c}"))
        support = hit + F.col(f"n{c}{other}")
        recall = safe(hit, support)
        f1 = safe(F.lit(2.0) * precision * recall, precision + recall)
        return F.struct(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), support.alias("support"))

    m = n.select("*", measures(0).alias("c0"), measures(1).alias("c1")).withColumn(
        "total", F.col("c0.support") + F.col("c1.support"))

    def line(name: str, value) -> Column:
        return F.struct(F.lit(name).alias("class"), *[value(k).alias(k) for k in ("precision", "recall", "f1")],
                        value("support").cast("bigint").alias("support"))

    def accuracy(_: str) -> Column:
        return F.col("total") if _ == "support" else safe(F.col("n00") + F.col("n11"), F.col("total"))

    def macro(k: str) -> Column:
        return F.col("total") if k == "support" else (F.col(f"c0.{k}") + F.col(f"c1.{k}")) / F.lit(2.0)

    def weighted(k: str) -> Column:
        if k == "support":
            return F.col("total")
        return safe(F.col(f"c0.{k}") * F.col("c0.support") + F.col(f"c1.{k}") * F.col("c1.support"), F.col("total"))

    lines = [line("0", lambda k: F.col(f"c0.{k}")), line("1", lambda k: F.col(f"c1.{k}")),
             line("accuracy", accuracy), line("macro avg", macro), line("weighted avg", weighted)]
    return m.select(F.inline(F.array(*lines)))
