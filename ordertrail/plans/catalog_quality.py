"""Data-quality operators. Orphan references come from dimensions that lack one state or category."""

from pyspark.sql import functions as F

from ..operators import quality
from ..sources import load_counts
from .catalog_star import FACT_SQL
from .registry import query
from .tables import Tables


def _partial_refs(t: Tables):
    return [
        ("customer_id", t.dim_customers.filter("customer_state <> 'NATION_3'"), False),
        ("product_id", t.dim_products.filter("product_category_name <> 'ECONOMY'"), True),
        ("seller_id", t.dim_sellers.filter("seller_state <> 'NATION_5'"), True),
    ]


_OK = """
    customer_id IN (SELECT customer_id FROM dim_customers WHERE customer_state <> 'NATION_3')
    AND (product_id IS NULL OR product_id IN
         (SELECT product_id FROM dim_products WHERE product_category_name <> 'ECONOMY'))
    AND (seller_id IS NULL OR seller_id IN (SELECT seller_id FROM dim_sellers WHERE seller_state <> 'NATION_5'))"""


@query("fk_filter", f"{FACT_SQL} WHERE {_OK}")
def _(t: Tables):
    return quality.fk_filter(t.fact, _partial_refs(t))


@query("fk_report", f"""
    SELECT 'customer_id' AS reason, count(*) AS dropped_rows FROM fact_orders
    WHERE customer_id IS NULL OR customer_id NOT IN
        (SELECT customer_id FROM dim_customers WHERE customer_state <> 'NATION_3')
    UNION ALL SELECT 'product_id', count(*) FROM fact_orders WHERE product_id NOT IN
        (SELECT product_id FROM dim_products WHERE product_category_name <> 'ECONOMY')
    UNION ALL SELECT 'seller_id', count(*) FROM fact_orders WHERE seller_id NOT IN
        (SELECT seller_id FROM dim_sellers WHERE seller_state <> 'NATION_5')
    UNION ALL SELECT 'any', count(*) FROM fact_orders WHERE NOT coalesce({_OK}, false)""")
def _(t: Tables):
    return quality.fk_report(t.fact, _partial_refs(t))


@query("j11_semi_null_pass", f"SELECT order_id, product_id FROM fact_orders WHERE product_id IS NULL OR product_id IN "
       "(SELECT product_id FROM dim_products WHERE product_category_en IS NOT NULL)")
def _(t: Tables):
    translated = t.dim_products.filter("product_category_en IS NOT NULL")
    return quality.fk_filter(t.fact.select("order_id", "product_id"), [("product_id", translated, True)])


@query("null_key_counts", """
    SELECT count(*) FILTER (WHERE product_id IS NULL) AS null_product_id,
           count(*) FILTER (WHERE customer_id IS NULL) AS null_customer_id FROM fact_orders""")
def _(t: Tables):
    return quality.null_key_counts(t.fact, ["product_id", "customer_id"])


@query("pk_check", "SELECT order_id, count(*) AS copies FROM raw_order_items GROUP BY order_id HAVING count(*) > 1")
def _(t: Tables):
    return quality.pk_check(t.order_items, "order_id")


@query("notnull_check", """
    SELECT order_id, customer_id, product_id, order_status FROM fact_orders
    WHERE product_id IS NULL OR order_status IS NULL""")
def _(t: Tables):
    rows = t.fact.select("order_id", "customer_id", "product_id", "order_status")
    return quality.notnull_check(rows, ["product_id", "order_status"])


@query("constraint_report", " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, 'unique {key}' AS "constraint", count(*) AS violations
        FROM (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)
        UNION ALL SELECT '{table}', 'not null {col}', count(*) FROM {source} WHERE {col} IS NULL"""
    for table, source, key, col in [("orders", "fact_orders", "order_id", "order_status"),
                                    ("lines", "raw_order_items", "order_id", "product_id")]))
def _(t: Tables):
    return quality.constraint_report(
        {"orders": t.fact, "lines": t.order_items}, {"orders": "order_id", "lines": "order_id"},
        {"orders": ["order_status"], "lines": ["product_id"]})


# one-digit states fit eight characters, and order values from 100,000 on do not fit seven digits
_KINDS = {"customer_id": "bigint", "customer_city": "varchar(100)", "customer_state": "varchar(8)"}
_FACT_KINDS = {"order_id": "bigint", "order_status": "varchar(50)", "order_revenue": "decimal(7,2)"}


@query("type_conform", """
    SELECT order_id, order_status, CAST(round(order_revenue, 1) AS DOUBLE) AS order_revenue,
           CAST(review_score AS DOUBLE) AS review_score FROM fact_orders""")
def _(t: Tables):
    return quality.type_conform(t.fact, {"order_id": "bigint", "order_status": "varchar(50)",
                                         "order_revenue": "decimal(10,1)", "review_score": "decimal(10,2)"})


@query("type_quarantine", """
    SELECT customer_id, customer_city, customer_state, 'customer_state' AS violations FROM dim_customers
    WHERE length(customer_state) > 8""")
def _(t: Tables):
    _, bad = quality.type_quarantine(t.dim_customers.select(*_KINDS), _KINDS)
    return bad.withColumn("violations", F.array_join("violations", ","))


@query("type_quarantine_counts", """
    SELECT 'fits' AS table_name, count(*) AS row_count FROM fact_orders
    WHERE order_revenue IS NULL OR order_revenue < 100000
    UNION ALL SELECT 'quarantined', count(*) FROM fact_orders WHERE order_revenue >= 100000""")
def _(t: Tables):
    good, bad = quality.type_quarantine(t.fact.select(*_FACT_KINDS), _FACT_KINDS)
    return load_counts({"fits": good, "quarantined": bad})
