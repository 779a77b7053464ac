"""Joins, sorting, limits and query composition."""

from pyspark.sql import functions as F

from ..functions import moment, percent, year_month
from ..operators.churn import churn_base, churn_label
from ..operators.members import keep_members
from ..operators.onerow import with_totals
from ..session import stored
from ..sources import read_sql
from .oracle_tables import r
from .registry import query
from .tables import Tables


@query("j1_join_translation", """
    SELECT product_id, product_category_name, product_category_name_english
    FROM raw_products LEFT JOIN raw_translation USING (product_category_name)""")
def _(t: Tables):
    return t.products.join(stored(t.translation, "translation"), "product_category_name", "left").select(
        "product_id", "product_category_name", "product_category_name_english")


@query("j2_join_aggregates", """
    SELECT order_id, items, CAST(paid AS DOUBLE) AS paid
    FROM (SELECT order_id, count(*) AS items FROM raw_order_items GROUP BY order_id)
    JOIN (SELECT order_id, sum(payment_value) AS paid FROM raw_payments GROUP BY order_id) USING (order_id)""")
def _(t: Tables):
    items = t.order_items.groupBy("order_id").agg(F.count("*").alias("items"))
    paid = t.payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    return items.join(paid, "order_id")


@query("join_left_fact", """
    SELECT order_id, order_status, product_id, CAST(price AS DOUBLE) AS price, review_score
    FROM raw_orders LEFT JOIN items_agg USING (order_id) LEFT JOIN review_agg USING (order_id)""")
def _(t: Tables):
    return t.fact.select("order_id", "order_status", "product_id", "price", "review_score")


@query("join_customer", """
    SELECT order_id, customer_id, customer_unique_id, customer_state FROM fact_orders
    JOIN dim_customers USING (customer_id)""")
def _(t: Tables):
    return t.fact.select("order_id", "customer_id").join(
        t.stored_customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id")


@query("join_product", """
    SELECT order_id, product_id, product_category_en FROM fact_orders JOIN dim_products USING (product_id)""")
def _(t: Tables):
    return t.fact.select("order_id", "product_id").join(
        t.stored_products.select("product_id", "product_category_en"), "product_id")


@query("join_seller", """
    SELECT order_id, seller_id, seller_state FROM fact_orders JOIN dim_sellers USING (seller_id)""")
def _(t: Tables):
    return t.fact.select("order_id", "seller_id").join(
        t.stored_sellers.select("seller_id", "seller_state"), "seller_id")


@query("join_payment", """
    SELECT f.order_id, payment_type, CAST(payment_value AS DOUBLE) AS payment_value
    FROM fact_orders f LEFT JOIN dim_payments p ON p.order_id = f.order_id""")
def _(t: Tables):
    return t.fact.select("order_id").join(t.dim_payments, "order_id", "left").select(
        "order_id", "payment_type", "payment_value")


@query("cross_total", f"""
    SELECT purchase_year, CAST(gmv AS DOUBLE) AS gmv, {r("gmv * 100.0 / total")} AS pct
    FROM (SELECT purchase_year, sum(order_revenue) AS gmv FROM fact_orders GROUP BY purchase_year),
         (SELECT sum(order_revenue) AS total FROM fact_orders)""")
def _(t: Tables):
    per_year = t.fact.groupBy("purchase_year").agg(F.sum("order_revenue").alias("gmv"))
    return with_totals(per_year, F.sum("gmv").alias("total")).select(
        "purchase_year", "gmv", percent("gmv", "total").alias("pct"))


@query("j9_join_label", """
    SELECT customer_unique_id, n, churned
    FROM (SELECT customer_unique_id, count(*) AS n FROM churn_base GROUP BY customer_unique_id)
    JOIN churn_label USING (customer_unique_id)""")
def _(t: Tables):
    base = churn_base(t.fact, t.stored_customers, t.stored_products, t.dim_payments)
    counts = base.groupBy("customer_unique_id").agg(F.count("*").alias("n"))
    return counts.join(churn_label(base).drop("last_purchase"), "customer_unique_id")


@query("semi_split", """
    SELECT order_id, customer_id FROM fact_orders WHERE customer_id IN (
        SELECT customer_id FROM fact_orders GROUP BY customer_id
        HAVING min(order_purchase_timestamp) < TIMESTAMP '1996-01-01')""")
def _(t: Tables):
    first = t.fact.groupBy("customer_id").agg(F.min("order_purchase_timestamp").alias("first"))
    early = first.filter(F.col("first") < moment("1996-01-01"))
    return keep_members(t.fact.select("order_id", "customer_id"), "customer_id", early)


@query("t1_order_by", """
    SELECT order_status, CAST(sum(order_revenue) AS DOUBLE) AS gmv FROM fact_orders GROUP BY order_status
    ORDER BY gmv DESC NULLS FIRST""")
def _(t: Tables):
    return t.fact.groupBy("order_status").agg(F.sum("order_revenue").alias("gmv")).orderBy(F.desc_nulls_first("gmv"))


@query("t2_order_by_hidden", """
    SELECT strftime(date_trunc('month', order_purchase_timestamp), '%Y-%m') AS order_month, count(*) AS n
    FROM fact_orders GROUP BY date_trunc('month', order_purchase_timestamp)
    ORDER BY date_trunc('month', order_purchase_timestamp)""")
def _(t: Tables):
    month = F.trunc("order_purchase_timestamp", "month").alias("month")
    return (t.fact.groupBy(month).agg(F.count("*").alias("n")).orderBy("month")
            .select(year_month("month").alias("order_month"), "n"))


@query("topk", """
    SELECT product_id, CAST(sum(order_revenue) AS DOUBLE) AS gmv FROM fact_orders
    WHERE product_id IS NOT NULL GROUP BY product_id ORDER BY gmv DESC, product_id LIMIT 10""")
def _(t: Tables):
    per_product = t.fact.filter("product_id IS NOT NULL").groupBy("product_id").agg(F.sum("order_revenue").alias("gmv"))
    return per_product.orderBy(F.desc("gmv"), "product_id").limit(10)


@query("u2_chained_ctes", """
    WITH per_customer AS (SELECT customer_id, count(*) AS orders FROM fact_orders GROUP BY customer_id),
         per_count AS (SELECT orders, count(*) AS customers FROM per_customer GROUP BY orders)
    SELECT orders, customers FROM per_count""")
def _(t: Tables):
    return read_sql(t.spark, """
        WITH per_customer AS (SELECT customer_id, count(*) AS orders FROM {fact} GROUP BY customer_id),
             per_count AS (SELECT orders, count(*) AS customers FROM per_customer GROUP BY orders)
        SELECT orders, customers FROM per_count""", {"fact": t.fact})


@query("u3_derived_table", """
    SELECT purchase_year, max(n) AS busiest FROM (
        SELECT purchase_year, purchase_month, count(*) AS n FROM fact_orders GROUP BY ALL) GROUP BY purchase_year""")
def _(t: Tables):
    monthly = t.fact.groupBy("purchase_year", "purchase_month").agg(F.count("*").alias("n"))
    return monthly.groupBy("purchase_year").agg(F.max("n").alias("busiest"))
