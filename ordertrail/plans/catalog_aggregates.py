"""Aggregates."""

from pyspark.sql import functions as F

from ..functions import first_nonnull, half_up, mode_or, most_frequent, ratio, sum_or_zero
from ..operators.churn import churn_base
from ..operators.rfm import describe
from ..session import stored
from .oracle_tables import r, re_
from .registry import query
from .tables import LINE_ORDER, Tables


@query("a1_count", "SELECT order_status, count(*) AS n FROM fact_orders GROUP BY order_status")
def _(t: Tables):
    return t.fact.groupBy("order_status").agg(F.count("*").alias("n"))


@query("a2_count_column", """
    SELECT order_status, count(order_revenue) AS with_revenue, count(review_score) AS reviewed
    FROM fact_orders GROUP BY order_status""")
def _(t: Tables):
    return t.fact.groupBy("order_status").agg(F.count("order_revenue").alias("with_revenue"),
                                              F.count("review_score").alias("reviewed"))


@query("count_distinct", """
    SELECT purchase_year, count(DISTINCT customer_id) AS customers, count(DISTINCT product_id) AS products
    FROM fact_orders GROUP BY purchase_year""")
def _(t: Tables):
    return t.fact.groupBy("purchase_year").agg(F.count_distinct("customer_id").alias("customers"),
                                               F.count_distinct("product_id").alias("products"))


@query("a5_sum", """
    SELECT customer_id, CAST(sum(order_revenue) AS DOUBLE) AS sql_sum,
           CAST(coalesce(sum(order_revenue), 0) AS DOUBLE) AS frame_sum FROM fact_orders GROUP BY customer_id""")
def _(t: Tables):
    return t.fact.groupBy("customer_id").agg(F.sum("order_revenue").alias("sql_sum"),
                                             sum_or_zero("order_revenue").alias("frame_sum"))


@query("a6_avg", f"""
    SELECT product_id, {r("sum(order_revenue) / count(order_revenue)")} AS avg_revenue,
           avg(review_score) AS avg_score FROM fact_orders GROUP BY product_id""")
def _(t: Tables):
    mean = ratio(F.sum("order_revenue"), F.count("order_revenue"))
    return t.fact.groupBy("product_id").agg(half_up(mean, 2).alias("avg_revenue"),
                                            F.avg("review_score").alias("avg_score"))


@query("a7_min", """
    SELECT seller_id, min(order_purchase_timestamp) AS first_order, CAST(min(delivery_delay_days) AS DOUBLE) AS earliest
    FROM fact_orders GROUP BY seller_id""")
def _(t: Tables):
    return t.fact.groupBy("seller_id").agg(F.min("order_purchase_timestamp").alias("first_order"),
                                           F.min("delivery_delay_days").alias("earliest"))


@query("a8_max", """
    SELECT customer_id, max(order_purchase_timestamp) AS last_order, CAST(max(order_revenue) AS DOUBLE) AS largest
    FROM fact_orders GROUP BY customer_id""")
def _(t: Tables):
    return t.fact.groupBy("customer_id").agg(F.max("order_purchase_timestamp").alias("last_order"),
                                             F.max("order_revenue").alias("largest"))


@query("first_nonnull", """
    SELECT order_id, arg_min(nullif(order_item_id, 1), (order_item_id, product_id, seller_id))
                         FILTER (WHERE order_item_id <> 1) AS first_later_line,
           arg_min(product_id, (order_item_id, product_id, seller_id)) AS first_product
    FROM raw_order_items GROUP BY order_id""")
def _(t: Tables):
    return t.order_items.groupBy("order_id").agg(
        first_nonnull("nullif(order_item_id, 1)", LINE_ORDER).alias("first_later_line"),
        first_nonnull("product_id", LINE_ORDER).alias("first_product"))


@query("most_frequent", """
    SELECT order_id, payment_type FROM payment_type_counts WHERE payment_type IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY n DESC, payment_type) = 1""")
def _(t: Tables):
    return t.payments.groupBy("order_id").agg(most_frequent("payment_type").alias("payment_type"))


@query("mode_or_unknown", """
    SELECT customer_unique_id, coalesce(top_category, 'unknown') AS top_category
    FROM (SELECT DISTINCT customer_unique_id FROM churn_base) LEFT JOIN top_category USING (customer_unique_id)""")
def _(t: Tables):
    base = churn_base(t.fact, t.stored_customers, t.stored_products, t.dim_payments)
    return base.groupBy("customer_unique_id").agg(mode_or("product_category_en").alias("top_category"))


@query("sum_case", """
    SELECT customer_id, CAST(sum(CASE WHEN order_status = 'canceled' THEN order_revenue ELSE 0 END) AS DOUBLE) AS lost
    FROM fact_orders GROUP BY customer_id""")
def _(t: Tables):
    lost = F.when(F.col("order_status") == "canceled", F.col("order_revenue")).otherwise(F.lit(0))
    return t.fact.groupBy("customer_id").agg(F.sum(lost).alias("lost"))


@query("a13_many_aggregates", """
    SELECT seller_id, count(*) AS n, CAST(sum(price) AS DOUBLE) AS price, max(review_score) AS best,
           min(review_score) AS worst, count(DISTINCT customer_id) AS customers
    FROM fact_orders GROUP BY seller_id""")
def _(t: Tables):
    return t.fact.groupBy("seller_id").agg(
        F.count("*").alias("n"), F.sum("price").alias("price"), F.max("review_score").alias("best"),
        F.min("review_score").alias("worst"), F.count_distinct("customer_id").alias("customers"))


@query("a14_global", """
    SELECT count(*) AS n, CAST(sum(order_revenue) AS DOUBLE) AS gmv, max(order_purchase_timestamp) AS newest
    FROM fact_orders""")
def _(t: Tables):
    return t.fact.agg(F.count("*").alias("n"), F.sum("order_revenue").alias("gmv"),
                      F.max("order_purchase_timestamp").alias("newest"))


@query("having", "SELECT customer_id, count(*) AS n FROM fact_orders GROUP BY customer_id HAVING count(*) > 10")
def _(t: Tables):
    return t.fact.groupBy("customer_id").agg(F.count("*").alias("n")).filter("n > 10")


@query("a16_group_by_hidden", """
    SELECT count(*) AS n, CAST(sum(order_revenue) AS DOUBLE) AS gmv FROM fact_orders
    GROUP BY date_trunc('month', order_purchase_timestamp)""")
def _(t: Tables):
    by_month = t.fact.groupBy(F.trunc("order_purchase_timestamp", "month").alias("month"))
    return by_month.agg(F.count("*").alias("n"), F.sum("order_revenue").alias("gmv")).drop("month")


@query("a17_constant_key", """
    SELECT order_status, total, count(*) AS n FROM fact_orders, (SELECT count(*) AS total FROM fact_orders)
    GROUP BY order_status, total""")
def _(t: Tables):
    # the constant adds nothing to the grouping: count per status first, then the total of the few rows
    per_status = t.fact.groupBy("order_status").agg(F.count("*").alias("n"))
    total = per_status.agg(F.sum("n").alias("total"))
    return per_status.crossJoin(F.broadcast(total)).select("order_status", "total", "n")


@query("a6_avg_half_even", f"""
    SELECT order_id, {re_("avg(review_score)", 1)} AS score FROM raw_reviews GROUP BY order_id""")
def _(t: Tables):
    return t.reviews.groupBy("order_id").agg(
        F.bround(F.avg("review_score").cast("decimal(38,10)"), 1).alias("score"))


_DESCRIBED = ["order_revenue", "review_score", "delivery_delay_days"]


def _described(c: str) -> str:
    v = f"CAST({c} AS DOUBLE)"
    return f"""
    SELECT '{c}' AS metric, count({c}) AS count, {re_(f"avg({v})")} AS mean, {re_(f"stddev_samp({v})")} AS std,
           {re_(f"min({v})")} AS min, {re_(f"quantile_cont({v}, 0.25)")} AS p25, {re_(f"quantile_cont({v}, 0.5)")} AS p50,
           {re_(f"quantile_cont({v}, 0.75)")} AS p75, {re_(f"max({v})")} AS max FROM fact_orders"""


@query("describe", " UNION ALL ".join(map(_described, _DESCRIBED)))
def _(t: Tables):
    return describe(stored(t.fact.select(*_DESCRIBED), "described"), _DESCRIBED)
