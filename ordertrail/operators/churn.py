"""Churn label, customer features, encoding and time split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import days_before, first_nonnull, ident, mode_or, moment, sum_or_zero, text_literal
from ..session import stored
from .onerow import with_overall_max
from .ordered import running_totals

# The columns of the model, the days without a purchase, and the date of the split.
CATEGORICAL = ["customer_state", "top_category", "top_payment"]
FEATURES = [
    "total_orders", "total_revenue", "avg_order_value", "avg_review_score", "avg_delivery_delay", "avg_freight",
    *CATEGORICAL, "purchase_month", "purchase_dow",
]
# What a missing mean is replaced by.
FILL = {"avg_review_score": 3.0, "avg_delivery_delay": 0.0}
CHURN_DAYS = 90
SPLIT_DATE = "2018-01-01"


def churn_base(fact: DataFrame, customers: DataFrame, products: DataFrame, payments: DataFrame) -> DataFrame:
    """Delivered orders with customer, product category and payment type.

    Orders without a product are left out; orders without a payment stay. Payments join first, on the
    fact's own key. Written dimensions let Catalyst broadcast a small one by its file size and let
    adaptive execution split a product that holds many orders.
    """
    delivered = fact.filter("order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL")
    return (
        delivered.join(payments.select("order_id", "payment_type"), "order_id", "left")
        .join(customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id")
        .join(products.select("product_id", "product_category_en"), "product_id")
        .select("order_id", "customer_unique_id", "customer_state", "order_purchase_timestamp", "order_status",
                "order_revenue", "price", "freight_value", "review_score", "delivery_delay_days", "payment_type",
                "purchase_year", "purchase_month", "purchase_day_of_week", "product_category_en")
    )


def _churned(last: str, newest: str, days: int) -> Column:
    return (F.col(last) < days_before(newest, days)).cast("int")


def churn_label(base: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    """1 for a customer whose last purchase is more than ``days`` before the last of all."""
    last = (base.filter(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id")
            .agg(F.max("order_purchase_timestamp").alias("last_purchase")))
    return with_overall_max(last, "last_purchase", "newest").select(
        "customer_unique_id", "last_purchase", _churned("last_purchase", "newest", days).alias("churned"))


def churn_rate(labels: DataFrame, label: str = "churned") -> DataFrame:
    """Percentage churned, and the two counts, as one row."""
    return labels.agg(
        (F.avg(label) * 100).alias("churn_rate_pct"),
        F.count_if(F.col(label) == 1).alias("churned"),
        F.count_if(F.col(label) == 0).alias("active"),
    )


def _mean(column: str) -> Column:
    # money and delays are decimals: an exact sum, divided once, does not depend on row order
    return F.expr(f"CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0)")


def customer_profile(base: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    """Per customer the features before encoding, first and last purchase, and the churn label.

    Features and label come from one aggregation, which is written once: the last purchase of all, which the label
    needs, is then one column of a table and not the aggregation over again.
    """
    grouped = stored(base.filter(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(
        F.count("order_id").alias("total_orders"),
        sum_or_zero("order_revenue").cast("double").alias("total_revenue"),
        _mean("order_revenue").alias("avg_order_value"),
        _mean("review_score").alias("avg_review_score"),
        _mean("delivery_delay_days").alias("avg_delivery_delay"),
        _mean("freight_value").alias("avg_freight"),
        first_nonnull("customer_state", ["order_purchase_timestamp", "order_id"]).alias("customer_state"),
        mode_or("product_category_en").alias("top_category"),
        mode_or("payment_type").alias("top_payment"),
        _mean("purchase_month").alias("purchase_month"),
        _mean("purchase_day_of_week").alias("purchase_dow"),
        F.min("order_purchase_timestamp").alias("first_purchase"),
        F.max("order_purchase_timestamp").alias("last_purchase"),
    ), "profile")
    newest = grouped.agg(F.max("last_purchase").alias("newest"))  # one row
    return (
        grouped.crossJoin(F.broadcast(newest))
        .withColumn("churned", _churned("last_purchase", "newest", days))
        .drop("newest")
    )


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes of text columns: (column, value, code), codes 0..n-1 in sorted order of the values.

    NULL counts as the value 'nan'. The values are ranked by range partitions, not in one task.
    """
    pairs = ", ".join(f"struct({text_literal(c)} AS column, coalesce(CAST({ident(c)} AS STRING), 'nan') AS value)"
                      for c in columns)
    distinct = df.selectExpr(f"inline(array({pairs}))").distinct().selectExpr("*", "1L AS one")
    return running_totals(distinct, ["value"], ["one"], ["column"]).selectExpr(
        "column", "value", "CAST(before_one AS INT) AS code")


def label_encode(df: DataFrame, columns: Sequence[str] = tuple(CATEGORICAL)) -> DataFrame:
    """Replace text columns by their codes, fitted on all rows.

    The codes are written, so their size decides how they are joined, and a hot value can be split.
    """
    codes = stored(label_codes(df, columns), "codes")
    for col in columns:
        lookup = codes.filter(F.col("column") == col).selectExpr("value AS _value", "code AS _code")
        text = F.expr(f"coalesce(CAST({ident(col)} AS STRING), 'nan')")
        df = df.join(lookup, text == F.col("_value"), "left").withColumn(col, F.col("_code")).drop("_value", "_code")
    return df


def customer_features(base: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    """Model input per customer: eleven numeric features, the label, and the first purchase."""
    return label_encode(customer_profile(base, days)).fillna(FILL).select(
        "customer_unique_id", *FEATURES, "churned", "first_purchase")


def time_split(features: DataFrame, split_date: str = SPLIT_DATE, first: str = "first_purchase") -> DataFrame:
    """Add ``split``: 'train' for customers whose first purchase is before the date, else 'test'."""
    at = moment(split_date)
    return features.withColumn("split", F.when(F.col(first) < at, "train").when(F.col(first) >= at, "test"))


def split_rows(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")


def split_stats(split: DataFrame) -> DataFrame:
    """Size and churn percentage of each part."""
    return split.filter(F.col("split").isNotNull()).groupBy("split").agg(
        F.count("*").alias("customers"), (F.avg("churned") * 100).alias("churn_rate_pct"))


def class_weight(train: DataFrame, label: str = "churned") -> DataFrame:
    """Weight of a positive row, negatives / positives, as one row; NULL if either class is empty."""
    neg, pos = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return train.agg((F.nullif(neg, F.lit(0)) / F.nullif(pos, F.lit(0))).alias("scale_pos_weight"))


def nan_policy(df: DataFrame, columns: Sequence[str], train: Column) -> DataFrame:
    """Replace NULL and NaN by the mean over the rows of ``train`` and add ``<column>_missing`` (0/1)."""
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    means = df.agg(*[F.avg(F.when(train, clean[c])).alias(f"_mean_{c}") for c in columns])
    wide = df.crossJoin(F.broadcast(means))
    filled = {c: F.coalesce(clean[c], F.col(f"_mean_{c}")) for c in columns}
    flags = {f"{c}_missing": clean[c].isNull().cast("int") for c in columns}
    return wide.withColumns(flags).withColumns(filled).select(*df.columns, *flags)
