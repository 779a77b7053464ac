"""Retention, revenue at risk, and a churn label that looks forward."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import days_before, moment, percent, whole_days, year_month
from .churn import CHURN_DAYS


def cohort_retention(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers active per month since their first delivered order, and their share of the cohort.

    Orders become distinct (customer, month) pairs before they are counted, at most one per calendar
    month and customer.
    """
    months = (
        fact.filter((F.col("order_status") == "delivered") & F.col("order_purchase_timestamp").isNotNull()
                    & F.col("customer_id").isNotNull())
        .select("customer_id", F.trunc("order_purchase_timestamp", "month").alias("month")).distinct()
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .filter(F.col("customer_unique_id").isNotNull())
        .select("customer_unique_id", "month").distinct()
    )
    # a customer's months are a short list, so the first one is found on the list and not by a second join
    lists = months.groupBy("customer_unique_id").agg(F.collect_set("month").alias("months"))
    active = lists.select(F.array_min("months").alias("cohort"), F.explode("months").alias("month"))
    age = ((F.year("month") - F.year("cohort")) * 12 + F.month("month") - F.month("cohort")).alias("age_months")
    counted = active.groupBy("cohort", age).agg(F.count("*").alias("active_customers"))
    # one row per pair of months from here on
    size = counted.filter(F.col("age_months") == 0).select(
        F.col("cohort").alias("_cohort"), F.col("active_customers").alias("cohort_size"))
    return (
        counted.join(size, F.col("cohort") == F.col("_cohort"))
        .select(year_month("cohort").alias("cohort_month"), "age_months", "active_customers",
                "cohort_size", percent("active_customers", "cohort_size").alias("retention_pct"))
        .orderBy("cohort_month", "age_months")
    )


def observed_days(fact: DataFrame) -> DataFrame:
    """Days from the first to the last delivered order, both included, as one row."""
    at = "order_purchase_timestamp"
    span = fact.filter(F.col("order_status") == "delivered").agg(F.min(at).alias("a"), F.max(at).alias("b"))
    return span.select((whole_days("b", "a") + 1).alias("days"))


def revenue_at_risk(scored: DataFrame, segments: DataFrame, days: DataFrame) -> DataFrame:
    """Daily revenue at risk per segment: the revenue of customers predicted to churn over the observed
    days, and the same weighted by probability. ``days`` has one row."""
    joined = scored.join(segments.select("customer_unique_id", "segment"), "customer_unique_id")
    revenue = F.col("total_revenue").cast("decimal(20,2)")
    grouped = joined.groupBy("segment").agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("churn_prediction") == 1).alias("customers_at_risk"),
        F.coalesce(F.sum(F.when(F.col("churn_prediction") == 1, revenue)), F.lit(0)).cast("double").alias("at_risk"),
        F.sum(F.col("total_revenue") * F.col("churn_probability")).alias("expected"),
    )
    return grouped.crossJoin(F.broadcast(days)).select(
        "segment", "customers", "customers_at_risk",
        (F.col("at_risk") / F.col("days")).alias("daily_gmv_at_risk"),
        (F.col("expected") / F.col("days")).alias("daily_gmv_expected_loss"))


def forward_churn_label(base: DataFrame, cut_date: str, days: int = CHURN_DAYS) -> DataFrame:
    """Customers with an order before the date: what they did until then, and 1 if they have no order in
    the ``days`` after it."""
    at = F.col("order_purchase_timestamp")
    cut = moment(cut_date)
    before, after = at < cut, (at >= cut) & (at < days_before(cut, -days))
    return (
        base.filter(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(
            F.count_if(before).alias("orders_before"),
            F.coalesce(F.sum(F.when(before, F.col("order_revenue"))), F.lit(0)).cast("double").alias("revenue_before"),
            F.max(F.when(before, at)).alias("last_before"),
            F.count_if(after).alias("orders_after"),
        )
        .filter(F.col("orders_before") > 0)
        .select("customer_unique_id", "orders_before", "revenue_before", "last_before",
                (F.col("orders_after") == 0).cast("int").alias("churned_next"))
    )
