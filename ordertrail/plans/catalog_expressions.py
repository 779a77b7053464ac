"""Projections, predicates and scalar expressions over the order fact."""

from pyspark.sql import functions as F

from ..functions import (
    date_parts,
    days_before,
    half_even,
    half_up,
    moment,
    parse_ts,
    ratio,
    whole_days,
    year_month,
)
from ..operators.onerow import with_overall_max
from .oracle_tables import r, re_
from .registry import query
from .tables import SPLIT_DATE, Tables

PURCHASED = "order_purchase_timestamp"


@query("p1_projection", "SELECT order_id, order_status, review_score FROM fact_orders")
def _(t: Tables):
    return t.fact.select("order_id", "order_status", "review_score")


@query("p2_rename", "SELECT order_id AS id, order_status AS status, purchase_year AS year FROM fact_orders")
def _(t: Tables):
    return (t.fact.select("order_id", "order_status", F.col("purchase_year").alias("year"))
            .withColumnRenamed("order_id", "id").withColumnRenamed("order_status", "status"))


@query("parse_ts", """
    SELECT order_id, TRY_CAST(txt AS TIMESTAMP) AS parsed FROM (
        SELECT order_id, CASE WHEN order_status = 'canceled' THEN 'junk ' || order_status
                              ELSE CAST(order_purchase_timestamp AS VARCHAR) END AS txt FROM raw_orders)""")
def _(t: Tables):
    text = F.when(F.col("order_status") == "canceled", F.concat(F.lit("junk "), "order_status")).otherwise(
        F.col(PURCHASED).cast("string"))
    return t.orders.select("order_id", text.alias("txt")).select("order_id", parse_ts("txt").alias("parsed"))


@query("order_revenue", "SELECT order_id, CAST(price + freight_value AS DOUBLE) AS order_revenue FROM fact_orders")
def _(t: Tables):
    return t.fact.select("order_id", "order_revenue")


@query("date_parts", """
    SELECT order_id, CAST(year(order_delivered_customer_date) AS INTEGER) AS y,
           CAST(month(order_delivered_customer_date) AS INTEGER) AS m,
           CAST(isodow(order_delivered_customer_date) - 1 AS INTEGER) AS dow FROM fact_orders""")
def _(t: Tables):
    y, m, dow = date_parts("order_delivered_customer_date")
    return t.fact.select("order_id", y.alias("y"), m.alias("m"), dow.alias("dow"))


@query("delivery_delay", """
    SELECT order_id, CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date))
                                / 86400000000) AS INTEGER) AS delay FROM raw_orders""")
def _(t: Tables):
    return t.orders.select(
        "order_id", whole_days("order_delivered_customer_date", "order_estimated_delivery_date").cast("int")
        .alias("delay"))


@query("p8_compare", """
    SELECT order_id FROM fact_orders WHERE order_status <> 'delivered' AND order_revenue > 1000
    AND review_score >= 2 AND delivery_delay_days < 200 AND purchase_year = 1998""")
def _(t: Tables):
    return t.fact.filter(
        (F.col("order_status") != "delivered") & (F.col("order_revenue") > 1000) & (F.col("review_score") >= 2)
        & (F.col("delivery_delay_days") < 200) & (F.col("purchase_year") == 1998)).select("order_id")


@query("p9_in_list", """
    SELECT order_id, order_status FROM fact_orders WHERE order_status IN ('shipped', 'delivered', 'canceled')""")
def _(t: Tables):
    return t.fact.filter(F.col("order_status").isin("shipped", "delivered", "canceled")).select("order_id", "order_status")


@query("p10_known_status", """
    SELECT order_id, order_status FROM fact_orders EXCEPT ALL
    SELECT order_id, order_status FROM fact_orders WHERE coalesce(order_status, 'none') = 'none'""")
def _(t: Tables):
    # 'not in some list, or not NULL' holds for exactly the known statuses, whatever is in the list
    return t.fact.filter(F.col("order_status").isNotNull()).select("order_id", "order_status")


@query("p11_null_tests", """
    SELECT order_id, CAST(order_status IS NULL AND order_revenue IS NOT NULL AS INTEGER) AS odd FROM fact_orders
    WHERE order_purchase_timestamp IS NOT NULL""")
def _(t: Tables):
    odd = F.col("order_status").isNull() & F.col("order_revenue").isNotNull()
    return t.fact.filter(F.col(PURCHASED).isNotNull()).select("order_id", odd.alias("odd"))


@query("p12_and_or", """
    SELECT order_id FROM fact_orders
    WHERE (order_status = 'canceled' OR review_score = 1) AND NOT (purchase_month = 12 OR order_revenue IS NULL)""")
def _(t: Tables):
    return t.fact.filter(
        ((F.col("order_status") == "canceled") | (F.col("review_score") == 1))
        & ~((F.col("purchase_month") == 12) | F.col("order_revenue").isNull())).select("order_id")


@query("p13_case_when", """
    SELECT order_id, CASE WHEN delivery_delay_days > 0 THEN 'late' WHEN delivery_delay_days <= 0 THEN 'on time'
                          ELSE 'unknown' END AS outcome FROM fact_orders""")
def _(t: Tables):
    delay = F.col("delivery_delay_days")
    return t.fact.select("order_id", F.when(delay > 0, "late").when(delay <= 0, "on time").otherwise("unknown")
                         .alias("outcome"))


@query("p14_coalesce_nullif", """
    SELECT order_id, coalesce(order_status, 'unknown') AS status, nullif(review_score, 1) AS score FROM fact_orders""")
def _(t: Tables):
    return t.fact.select("order_id", F.coalesce("order_status", F.lit("unknown")).alias("status"),
                         F.nullif("review_score", F.lit(1)).alias("score"))


@query("fill_defaults", """
    SELECT order_id, coalesce(CAST(review_score AS DOUBLE), 3.0) AS review_score,
           coalesce(CAST(delivery_delay_days AS DOUBLE), 0.0) AS delivery_delay_days FROM fact_orders""")
def _(t: Tables):
    rows = t.fact.select("order_id", F.col("review_score").cast("double").alias("review_score"),
                         F.col("delivery_delay_days").cast("double").alias("delivery_delay_days"))
    return rows.fillna({"review_score": 3.0, "delivery_delay_days": 0.0})


@query("p16_round_half_up", f"SELECT order_id, {r('order_revenue / 8', 2)} AS v FROM fact_orders")
def _(t: Tables):
    return t.fact.select("order_id", half_up(ratio("order_revenue", F.lit(8)), 2).alias("v"))


@query("p17_round_half_even", f"SELECT order_id, {re_('order_revenue / 8', 2)} AS v FROM fact_orders")
def _(t: Tables):
    return t.fact.select("order_id", half_even(ratio("order_revenue", F.lit(8)), 2).alias("v"))


@query("p18_month_text", """
    SELECT order_id, date_trunc('month', order_purchase_timestamp)::TIMESTAMP AS month,
           strftime(order_purchase_timestamp, '%Y-%m') AS txt FROM fact_orders""")
def _(t: Tables):
    return t.fact.select("order_id", F.trunc(PURCHASED, "month").cast("timestamp_ntz").alias("month"),
                         year_month(PURCHASED).alias("txt"))


@query("p19_shift_days", """
    SELECT order_id, order_purchase_timestamp + INTERVAL 1 DAY AS next_day,
           order_purchase_timestamp - INTERVAL 90 DAY AS earlier FROM fact_orders""")
def _(t: Tables):
    return t.fact.select("order_id", days_before(PURCHASED, -1).alias("next_day"),
                         days_before(PURCHASED, 90).alias("earlier"))


@query("p20_days_since", """
    SELECT customer_id, CAST(floor((epoch_us(ref) - epoch_us(max(order_delivered_customer_date))) / 86400000000)
                             AS INTEGER) AS days
    FROM fact_orders, (SELECT max(order_delivered_customer_date) AS ref FROM fact_orders)
    GROUP BY customer_id, ref""")
def _(t: Tables):
    last = t.fact.groupBy("customer_id").agg(F.max("order_delivered_customer_date").alias("last"))
    return with_overall_max(last, "last", "newest").select(
        "customer_id", whole_days("newest", "last").cast("int").alias("days"))


@query("p21_bool_to_int", """
    SELECT order_id, CAST(order_purchase_timestamp < TIMESTAMP '1998-01-01' AS INTEGER) AS early FROM fact_orders""")
def _(t: Tables):
    return t.fact.select("order_id", (F.col(PURCHASED) < moment("1998-01-01")).cast("int")
                         .alias("early"))


@query("p22_date_literal", f"""
    SELECT order_id FROM fact_orders WHERE order_purchase_timestamp >= TIMESTAMP '{SPLIT_DATE} 00:00:00'""")
def _(t: Tables):
    return t.fact.filter(F.col(PURCHASED) >= moment(SPLIT_DATE)).select("order_id")


@query("p23_map_values", """
    SELECT order_id, CASE order_status WHEN 'delivered' THEN 'done' WHEN 'canceled' THEN 'lost'
                                       WHEN 'unavailable' THEN 'lost' END AS outcome FROM fact_orders""")
def _(t: Tables):
    # Outcome per status.
    outcome = {"delivered": "done", "canceled": "lost", "unavailable": "lost"}
    lookup = F.create_map(*[F.lit(x) for pair in outcome.items() for x in pair])
    return t.fact.select("order_id", F.try_element_at(lookup, "order_status").alias("outcome"))


@query("p24_exact_ratio", f"""
    SELECT customer_id, {r("count(*) FILTER (WHERE order_status = 'delivered') * 100.0 / count(*)")} AS pct
    FROM fact_orders GROUP BY customer_id""")
def _(t: Tables):
    delivered = F.count_if(F.col("order_status") == "delivered")
    return t.fact.groupBy("customer_id").agg(half_up(ratio(delivered * 100, F.count("*")), 2).alias("pct"))
