"""Churn models: logistic regression of ``pyspark.ml``, and boosted trees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .boosting import BoostedTrees
from .churn import FEATURES, class_weight, nan_policy
from .segments import as_vectors


def model_input(split: DataFrame, columns: Sequence[str] = tuple(FEATURES)) -> tuple[DataFrame, list[str]]:
    """Feature vectors without gaps, and the names of their columns.

    Columns that hold gaps are filled with the train mean and get a 0/1 column; with no gap the
    columns stay as they are.
    """
    gaps = split.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c)
                       for c in columns]).first()
    gappy = [c for c in columns if gaps[c]]
    names = list(columns) + [f"{c}_missing" for c in gappy]
    if gappy:
        split = nan_policy(split, gappy, F.col("split") == "train")
    return as_vectors(split, names), names


# The defaults of both fits below.


def fit_logistic(train: DataFrame, label: str = "churned", c: float = 1.0, max_iter: int = 1000) -> LogisticRegressionModel:
    """L2-penalised logistic regression on the unscaled columns.

    ``c`` is the inverse penalty on the summed loss; Spark averages the loss, hence the division by the
    number of rows.
    """
    model = LogisticRegression(labelCol=label, maxIter=max_iter, regParam=1.0 / (c * train.count()),
                               elasticNetParam=0.0, standardization=False).fit(train)
    # its training summary holds the session, which cannot travel to tasks once a metric was observed in it
    model._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
    return model


def fit_gbt(train: DataFrame, columns: Sequence[str] = tuple(FEATURES), label: str = "churned", max_iter: int = 300,
            max_depth: int = 5, step_size: float = 0.05, max_bins: int = 256) -> BoostedTrees:
    """Boosted trees on the columns as they are, gaps included; positive rows are weighted by negatives / positives where
    both classes occur."""
    weight = class_weight(train, label).first()["scale_pos_weight"] or 1.0
    return boosting.fit(train, columns, label, max_iter, max_depth, step_size, float(weight), max_bins=max_bins)


def score(model: BoostedTrees | LogisticRegressionModel, df: DataFrame) -> DataFrame:
    """Add ``churn_probability`` and ``churn_prediction`` (at 0.5); a logistic model reads the feature vectors, boosted
    trees their columns."""
    if isinstance(model, BoostedTrees):
        scored = boosting.margin(model, df, "_margin")
        return scored.withColumn("churn_probability", 1 / (1 + F.exp(-F.col("_margin")))).withColumn(
            "churn_prediction", (F.col("_margin") > 0).cast("int")).drop("_margin")
    scored = model.transform(df)
    return (
        scored.withColumn("churn_probability", vector_to_array("probability")[1])
        .withColumn("churn_prediction", F.col("prediction").cast("int"))
        .drop("rawPrediction", "probability", "prediction")
    )


def logistic_score(df: DataFrame, coefficients: Mapping[str, float], intercept: float) -> DataFrame:
    """Add ``churn_probability`` and ``churn_prediction`` (over 0.5) of a logistic model with stated coefficients."""
    margin = sum((F.col(c) * F.lit(float(v)) for c, v in coefficients.items()), F.lit(float(intercept)))
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return df.withColumn("churn_probability", probability).withColumn(
        "churn_prediction", (F.col("churn_probability") > 0.5).cast("int"))


# The columns of the churn extract.
EXPORT = ["customer_unique_id", "total_orders", "total_revenue", "avg_order_value", "churn_probability",
          "churn_prediction", "churned"]


def churn_export(scored: DataFrame) -> DataFrame:
    """The scored customers of both parts, seven columns."""
    return scored.select(*EXPORT)


def top_risk(scored: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` customers most likely to churn; ties go by id."""
    return scored.orderBy(F.desc("churn_probability"), "customer_unique_id").limit(n)


def margin(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """The tree model's raw score per customer."""
    return boosting.margin(model, df).select("customer_unique_id", "margin")
