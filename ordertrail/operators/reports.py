"""Lifecycle reports over the order fact.

Reports by an attribute of a dimension aggregate the fact by its foreign key first and join after.
A key that holds a large share of all orders is then one row per task before the shuffle, so the join
has no skew and needs no broadcast, whatever the size of the dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import half_up, ident, percent, ratio, text_literal, year_month

# Lifecycle stages in order, each with the statuses that have reached it.
# The second stage is every known status but the first one.
REACHED = {
    "invoiced": ["invoiced", "processing", "shipped", "delivered", "canceled"],
    "processing": ["processing", "shipped", "delivered", "canceled"],
    "shipped": ["shipped", "delivered", "canceled"],
    "delivered": ["delivered"],
}


def lifecycle_stages(status: str = "order_status") -> list[tuple[str, str]]:
    """The six cumulative stages as (name, SQL predicate); a NULL status has reached only the first."""
    def one_of(names: Sequence[str]) -> str:
        return f"{ident(status)} IN ({', '.join(map(text_literal, names))})"
    stages = [("created", "true"), ("approved", f"{ident(status)} <> 'created'")]
    return stages + [(name, one_of(reached)) for name, reached in REACHED.items()]


def stage_counts(df: DataFrame, stages: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """One wide row (per segment) with the number of orders that reached each stage."""
    return df.groupBy(*by).agg(*[F.expr(f"count_if({predicate}) AS {ident(name)}") for name, predicate in stages])


def unpivot_stages(wide: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Turn stage columns into rows (step, stage, cnt, total) in one pass over ``wide``."""
    rows = ", ".join(f"{i}, {text_literal(name)}, {ident(name)}, {ident(names[0])}" for i, name in enumerate(names, 1))
    return wide.selectExpr(*map(ident, by), f"stack({len(names)}, {rows}) AS (step, stage, cnt, total)")


def dropoff(df: DataFrame, count: str = "cnt", step: str = "step", by: Sequence[str] = ()) -> DataFrame:
    """Add the percentage lost since the previous step. The input is one row per step and segment."""
    previous = F.lag(count).over(Window.partitionBy(*by).orderBy(step))
    return df.withColumn("dropoff_pct", percent(previous - F.col(count), previous))


def funnel_conversion(df: DataFrame, stages: Sequence[tuple[str, str]] | None = None,
                      by: Sequence[str] = ()) -> DataFrame:
    """Orders per stage, share of all orders, and percentage lost since the stage before."""
    stages = lifecycle_stages() if stages is None else stages
    names = [name for name, _ in stages]
    long = unpivot_stages(stage_counts(df, stages, by), names, by)
    return (
        dropoff(long, by=by)
        .withColumn("conversion_pct", percent("cnt", "total"))
        .orderBy(*by, "step")
        .select(*by, "stage", "cnt", "conversion_pct", "dropoff_pct")
    )


def _by_status(fact: DataFrame) -> DataFrame:
    """Count, revenue and rows with revenue per status, next to the revenue of all statuses.

    The total is taken over the few grouped rows, so the fact is read once.
    """
    grouped = fact.groupBy("order_status").agg(*map(F.expr, [
        "count(*) AS order_count", "sum(order_revenue) AS revenue", "count(order_revenue) AS with_revenue"]))
    return grouped.withColumn("total", F.expr("sum(revenue) OVER ()"))


def revenue_leakage(fact: DataFrame) -> DataFrame:
    """Revenue per known status. The share is of the revenue of all orders, and the average order
    value divides by every order, also those without revenue."""
    gmv = half_up("revenue", 2)
    return (
        _by_status(fact)
        .filter(F.col("order_status").isNotNull())
        .select(
            "order_status", "order_count", gmv.alias("stage_gmv"),
            percent(gmv, "total").alias("pct_of_total_gmv"),
            half_up(ratio(gmv, "order_count"), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc_nulls_first("stage_gmv"), "order_status")
    )


def revenue_by_status(fact: DataFrame) -> DataFrame:
    """Revenue per status, a NULL status included. The average order value is over orders that have
    revenue."""
    return (
        _by_status(fact)
        .select(
            "order_status", "order_count", half_up("revenue", 2).alias("stage_gmv"),
            percent("revenue", "total").alias("pct_of_total_gmv"),
            half_up(ratio("revenue", "with_revenue"), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc_nulls_first("stage_gmv"), "order_status")
    )


def _rollup_by_dimension(fact: DataFrame, dim: DataFrame, key: str, attribute: str,
                         partials: Sequence[str], finals: Sequence[str], min_orders: int) -> DataFrame:
    """Aggregate by foreign key, look the attribute up, and roll the partial results up to it.

    ``partials`` are SQL aggregates per key, ``finals`` combine them.
    """
    known = fact.filter(f"{ident(key)} IS NOT NULL")
    per_key = known.groupBy(key).agg(*map(F.expr, ["count(*) AS n", *partials]))
    grouped = per_key.join(dim.select(key, attribute), key).groupBy(attribute)
    return grouped.agg(*map(F.expr, ["sum(n) AS total_orders", *finals])).filter(f"total_orders > {int(min_orders)}")


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def _cancellations(fact: DataFrame, dim: DataFrame, key: str, attribute: str, min_orders: int) -> DataFrame:
    grouped = _rollup_by_dimension(
        fact, dim, key, attribute,
        ["count_if(order_status = 'canceled') AS c",
         "sum(CASE WHEN order_status = 'canceled' THEN order_revenue ELSE 0 END) AS gmv"],
        ["sum(c) AS canceled_orders", "sum(gmv) AS gmv"],
        min_orders,
    )
    return (grouped.withColumn("cancel_rate_pct", percent("canceled_orders", "total_orders"))
            .withColumn("canceled_gmv", half_up("gmv", 2)))


def cancellation_by_state(fact: DataFrame, customers: DataFrame, min_orders: int = 100,
                          limit: int | None = None) -> DataFrame:
    """Cancellation rate and canceled revenue per customer state with more than ``min_orders`` orders."""
    rows = _cancellations(fact, customers, "customer_id", "customer_state", min_orders)
    return _limited(rows.select("customer_state", "total_orders", "canceled_orders", "cancel_rate_pct",
                                "canceled_gmv").orderBy(F.desc("cancel_rate_pct"), "customer_state"), limit)


def cancellation_by_category(fact: DataFrame, products: DataFrame, min_orders: int = 50,
                             limit: int | None = 10) -> DataFrame:
    """Cancellation rate per English product category; orders without a product are not counted."""
    rows = _cancellations(fact, products, "product_id", "product_category_en", min_orders)
    return _limited(
        rows.select(F.coalesce("product_category_en", F.lit("unknown")).alias("category"), "total_orders",
                    "canceled_orders", "cancel_rate_pct")
        .orderBy(F.desc("cancel_rate_pct"), "category"), limit)


def monthly_cohort(fact: DataFrame) -> DataFrame:
    """Delivered orders per calendar month of purchase: orders, distinct customers, revenue, average."""
    return (
        fact.filter("order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL")
        .groupBy(F.expr("trunc(order_purchase_timestamp, 'month') AS month"))
        .agg(*map(F.expr, [
            "count(*) AS total_orders", "count(DISTINCT customer_id) AS unique_customers",
            "sum(order_revenue) AS gmv", "count(order_revenue) AS with_revenue"]))
        .orderBy("month")
        .select(
            year_month("month").alias("order_month"), "total_orders", "unique_customers",
            half_up("gmv", 2).alias("monthly_gmv"),
            half_up(ratio("gmv", "with_revenue"), 2).alias("avg_order_value"),
        )
    )


def _delays(fact: DataFrame, sellers: DataFrame, min_orders: int) -> DataFrame:
    grouped = _rollup_by_dimension(
        fact.filter("order_status = 'delivered' AND delivery_delay_days IS NOT NULL"),
        sellers, "seller_id", "seller_state",
        ["sum(delivery_delay_days) AS days", "min(delivery_delay_days) AS lo", "max(delivery_delay_days) AS hi",
         "count_if(delivery_delay_days > 0) AS late"],
        ["sum(days) AS days", "min(lo) AS lo", "max(hi) AS hi", "sum(late) AS late_deliveries"],
        min_orders,
    )
    return grouped.select(
        "seller_state", "total_orders",
        half_up(ratio("days", "total_orders"), 2).alias("avg_delay_days"),
        half_up("lo", 2).alias("earliest_days"), half_up("hi", 2).alias("worst_delay_days"),
        "late_deliveries", percent("late_deliveries", "total_orders").alias("late_pct"),
    )


def delivery_delay_by_state(fact: DataFrame, sellers: DataFrame, min_orders: int = 100) -> DataFrame:
    """Delivery delay per seller state, largest share of late deliveries first."""
    return (_delays(fact, sellers, min_orders).drop("earliest_days")
            .orderBy(F.desc("late_pct"), "seller_state"))


def delivery_delay_by_state_top(fact: DataFrame, sellers: DataFrame, min_orders: int = 100,
                                limit: int = 10) -> DataFrame:
    """The ``limit`` seller states with the longest mean delay, with the earliest delivery too."""
    return (_delays(fact, sellers, min_orders)
            .orderBy(F.desc("avg_delay_days"), "seller_state").limit(limit))
