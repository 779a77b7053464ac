"""Star-schema builders."""

from pyspark.sql import functions as F

from ..operators import star
from ..operators.dedup import dedup_first
from .registry import query
from .tables import LINE_ORDER, Tables

_FACT_MONEY = ["price", "freight_value", "order_revenue", "delivery_delay_days"]
FACT_SQL = f"""
    SELECT * REPLACE ({", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _FACT_MONEY)}) FROM fact_orders"""
_DIMENSIONS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


@query("dim_customers", "SELECT * FROM dim_customers")
def _(t: Tables):
    return t.dim_customers


@query("dim_products", f"""
    SELECT * REPLACE ({", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DIMENSIONS)}) FROM dim_products""")
def _(t: Tables):
    return t.dim_products


@query("dim_sellers", "SELECT * FROM dim_sellers")
def _(t: Tables):
    return t.dim_sellers


@query("dim_payments", "SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM dim_payments")
def _(t: Tables):
    return t.dim_payments


@query("fact_orders", FACT_SQL)
def _(t: Tables):
    return t.fact


@query("items_agg", """
    SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value) FROM items_agg""")
def _(t: Tables):
    return star.items_agg(t.order_items, LINE_ORDER)


@query("review_agg", "SELECT * FROM review_agg")
def _(t: Tables):
    return star.review_agg(t.reviews)


@query("dedup_first", """
    SELECT order_id, order_item_id, product_id, CAST(price AS DOUBLE) AS price FROM raw_order_items
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_item_id DESC, product_id, price) = 1""")
def _(t: Tables):
    lines = t.order_items.select("order_id", "order_item_id", "product_id", "price",
                                 (-F.col("order_item_id")).alias("from_last"))
    return dedup_first(lines, "order_id", ["from_last", "product_id", "price"]).drop("from_last")
