"""The derived raw tables and the star as SQL common table expressions, for the independent check."""

from __future__ import annotations

import re

_MONEY = "DECIMAL(10,2)"

CTE = {
    "raw_customers": """
        SELECT c_custkey AS customer_id, c_custkey // 3 AS customer_unique_id, c_mktsegment AS customer_city,
               n_name AS customer_state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "raw_sellers": """
        SELECT s_suppkey AS seller_id, s_name AS seller_city, n_name AS seller_state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "raw_products": f"""
        SELECT p_partkey AS product_id, p_type AS product_category_name,
               CAST(p_size AS {_MONEY}) AS product_weight_g, CAST(p_retailprice AS {_MONEY}) AS product_length_cm,
               CAST(p_size AS {_MONEY}) AS product_height_cm, CAST(p_size AS {_MONEY}) AS product_width_cm
        FROM part""",
    "raw_translation": """
        SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
        FROM part WHERE p_type <> 'PROMO'""",
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    WHEN o_orderkey % 20 = 0 THEN 'created' WHEN o_orderkey % 20 = 1 THEN 'approved'
                    WHEN o_orderkey % 20 = 2 THEN 'invoiced' WHEN o_orderkey % 20 = 3 THEN 'processing'
                    WHEN o_orderkey % 20 = 4 THEN 'shipped' WHEN o_orderkey % 20 IN (5, 6) THEN 'canceled'
                    WHEN o_orderkey % 20 = 7 THEN 'unavailable' ELSE 'delivered' END AS order_status,
               o_orderdate AS order_purchase_timestamp, o_orderdate + INTERVAL 6 HOUR AS order_approved_at,
               carrier AS order_delivered_carrier_date, delivered AS order_delivered_customer_date,
               o_orderdate + INTERVAL 30 DAY + INTERVAL 12 HOUR AS order_estimated_delivery_date
        FROM orders LEFT JOIN (
            SELECT l_orderkey, min(l_shipdate) AS carrier, max(l_shipdate + to_hours(l_linenumber)) AS delivered
            FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "raw_order_items": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
               CAST(l_extendedprice AS {_MONEY}) AS price,
               CAST(CAST(l_extendedprice AS {_MONEY}) * CAST(l_tax AS {_MONEY}) AS {_MONEY}) AS freight_value
        FROM lineitem""",
    "raw_payments": f"""
        SELECT l_orderkey AS order_id, l_returnflag AS payment_type, l_linenumber AS payment_installments,
               CAST(CAST(l_extendedprice AS {_MONEY}) * (CAST(1 AS {_MONEY}) - CAST(l_discount AS {_MONEY}))
                    AS {_MONEY}) AS payment_value
        FROM lineitem""",
    "raw_reviews": """
        SELECT l_orderkey AS order_id, CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS INTEGER) AS review_score
        FROM lineitem""",
    "dim_customers": """
        SELECT customer_id, customer_unique_id, customer_city, customer_state FROM raw_customers
        QUALIFY row_number() OVER (PARTITION BY customer_id
                                   ORDER BY customer_unique_id, customer_city, customer_state) = 1""",
    "dim_sellers": """
        SELECT seller_id, seller_city, seller_state FROM raw_sellers
        QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY seller_city, seller_state) = 1""",
    "dim_products": """
        SELECT product_id, p.product_category_name, product_category_name_english AS product_category_en,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm
        FROM raw_products p LEFT JOIN raw_translation USING (product_category_name)
        QUALIFY row_number() OVER (PARTITION BY product_id
                                   ORDER BY p.product_category_name, product_weight_g, product_length_cm) = 1""",
    "payment_type_counts": """
        SELECT order_id, payment_type, count(*) AS n FROM raw_payments
        WHERE order_id IS NOT NULL GROUP BY order_id, payment_type""",
    "dim_payments": """
        SELECT order_id, payment_type, payment_installments, payment_value
        FROM (SELECT order_id, max(payment_installments) AS payment_installments,
                     coalesce(sum(payment_value), 0) AS payment_value
              FROM raw_payments WHERE order_id IS NOT NULL GROUP BY order_id)
        LEFT JOIN (SELECT order_id, payment_type FROM payment_type_counts WHERE payment_type IS NOT NULL
                   QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY n DESC, payment_type) = 1)
        USING (order_id)""",
    "items_agg": """
        SELECT order_id,
               arg_min(product_id, (order_item_id, product_id, seller_id)) FILTER (WHERE product_id IS NOT NULL)
                   AS product_id,
               arg_min(seller_id, (order_item_id, product_id, seller_id)) FILTER (WHERE seller_id IS NOT NULL)
                   AS seller_id,
               coalesce(sum(price), 0) AS price, coalesce(sum(freight_value), 0) AS freight_value
        FROM raw_order_items WHERE order_id IS NOT NULL GROUP BY order_id""",
    "review_agg": """
        SELECT order_id, CAST(round_even(CAST(avg(review_score) AS DECIMAL(38,10)), 0) AS INTEGER) AS review_score
        FROM raw_reviews WHERE order_id IS NOT NULL GROUP BY order_id""",
    "fact_orders": """
        SELECT order_id, customer_id, product_id, seller_id, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
               order_status, price, freight_value, price + freight_value AS order_revenue,
               CAST(year(order_purchase_timestamp) AS INTEGER) AS purchase_year,
               CAST(month(order_purchase_timestamp) AS INTEGER) AS purchase_month,
               CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS purchase_day_of_week,
               CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date))
                          / 86400000000) AS DECIMAL(10,2)) AS delivery_delay_days,
               review_score
        FROM raw_orders LEFT JOIN items_agg USING (order_id) LEFT JOIN review_agg USING (order_id)""",
    "rfm_orders": """
        SELECT customer_id, customer_unique_id, customer_state, order_purchase_timestamp, order_revenue, order_status
        FROM fact_orders JOIN dim_customers USING (customer_id)
        WHERE order_status = 'delivered' AND order_revenue IS NOT NULL AND order_purchase_timestamp IS NOT NULL""",
    "rfm": """
        SELECT customer_unique_id,
               CAST(floor((epoch_us(ref) - epoch_us(max(order_purchase_timestamp))) / 86400000000) AS INTEGER)
                   AS recency,
               count(order_purchase_timestamp) AS frequency, CAST(sum(order_revenue) AS DOUBLE) AS monetary,
               sum(order_revenue) AS monetary_dec
        FROM rfm_orders, (SELECT max(order_purchase_timestamp) + INTERVAL 1 DAY AS ref FROM rfm_orders)
        WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id, ref""",
    "rfm_fixed": "SELECT *, CAST(customer_unique_id % 4 AS INTEGER) AS cluster FROM rfm",
    "rfm_named": """
        SELECT f.*, segment FROM rfm_fixed f JOIN (
            SELECT cluster, ['Champions', 'Loyal', 'At-Risk', 'Lost'][row_number() OVER (ORDER BY m DESC, cluster)]
                   AS segment
            FROM (SELECT cluster, round_even(CAST(sum(monetary_dec) / count(*) AS DECIMAL(38,10)), 2) AS m
                  FROM rfm_fixed GROUP BY cluster)) USING (cluster)""",
    "churn_base": """
        SELECT f.order_id, customer_unique_id, customer_state, order_purchase_timestamp, order_status, order_revenue,
               price, freight_value, review_score, delivery_delay_days, payment_type, purchase_year, purchase_month,
               purchase_day_of_week, product_category_en
        FROM fact_orders f JOIN dim_customers USING (customer_id) JOIN dim_products USING (product_id)
        LEFT JOIN dim_payments p ON p.order_id = f.order_id
        WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL""",
    "churn_label": """
        SELECT customer_unique_id, last_purchase,
               CAST(last_purchase < (SELECT max(order_purchase_timestamp) - INTERVAL 90 DAY FROM churn_base)
                    AS INTEGER) AS churned
        FROM (SELECT customer_unique_id, max(order_purchase_timestamp) AS last_purchase FROM churn_base
              WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id)""",
    "top_category": """
        SELECT customer_unique_id, product_category_en AS top_category
        FROM (SELECT customer_unique_id, product_category_en, count(*) AS n FROM churn_base
              WHERE product_category_en IS NOT NULL GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY n DESC, product_category_en) = 1""",
    "top_payment": """
        SELECT customer_unique_id, payment_type AS top_payment
        FROM (SELECT customer_unique_id, payment_type, count(*) AS n FROM churn_base
              WHERE payment_type IS NOT NULL GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY n DESC, payment_type) = 1""",
    "customer_profile": """
        SELECT g.* EXCLUDE (top_state), top_state AS customer_state,
               coalesce(top_category, 'unknown') AS top_category, coalesce(top_payment, 'unknown') AS top_payment,
               last_purchase, churned
        FROM (SELECT customer_unique_id, count(order_id) AS total_orders,
                     CAST(coalesce(sum(order_revenue), 0) AS DOUBLE) AS total_revenue,
                     CAST(sum(order_revenue) AS DOUBLE) / count(order_revenue) AS avg_order_value,
                     CAST(sum(review_score) AS DOUBLE) / count(review_score) AS avg_review_score,
                     CAST(sum(delivery_delay_days) AS DOUBLE) / count(delivery_delay_days) AS avg_delivery_delay,
                     CAST(sum(freight_value) AS DOUBLE) / count(freight_value) AS avg_freight,
                     arg_min(customer_state, (order_purchase_timestamp, order_id))
                         FILTER (WHERE customer_state IS NOT NULL) AS top_state,
                     CAST(sum(purchase_month) AS DOUBLE) / count(purchase_month) AS purchase_month,
                     CAST(sum(purchase_day_of_week) AS DOUBLE) / count(purchase_day_of_week) AS purchase_dow,
                     min(order_purchase_timestamp) AS first_purchase
              FROM churn_base WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id) g
        LEFT JOIN top_category USING (customer_unique_id) LEFT JOIN top_payment USING (customer_unique_id)
        JOIN churn_label USING (customer_unique_id)""",
    "codes": """
        SELECT col, val, CAST(row_number() OVER (PARTITION BY col ORDER BY val) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT 'customer_state' AS col, coalesce(customer_state, 'nan') AS val FROM customer_profile
              UNION ALL SELECT DISTINCT 'top_category', top_category FROM customer_profile
              UNION ALL SELECT DISTINCT 'top_payment', top_payment FROM customer_profile)""",
    "features": """
        SELECT p.customer_unique_id, total_orders, total_revenue, avg_order_value,
               coalesce(avg_review_score, 3.0) AS avg_review_score,
               coalesce(avg_delivery_delay, 0.0) AS avg_delivery_delay, avg_freight,
               s.code AS customer_state, c.code AS top_category, t.code AS top_payment,
               purchase_month, purchase_dow, churned, first_purchase
        FROM customer_profile p
        JOIN codes s ON s.col = 'customer_state' AND s.val = coalesce(p.customer_state, 'nan')
        JOIN codes c ON c.col = 'top_category' AND c.val = p.top_category
        JOIN codes t ON t.col = 'top_payment' AND t.val = p.top_payment""",
    "scored": """
        SELECT customer_unique_id, churned, (customer_unique_id * 7919 % 1000) / 1000.0 AS churn_probability,
               CAST((customer_unique_id * 7919 % 1000) / 1000.0 >= 0.5 AS INTEGER) AS churn_prediction
        FROM churn_label""",
}


def _mentions(name: str, text: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None


def with_tables(query: str) -> str:
    """Prefix a query with the expressions it uses, directly or through others."""
    used: set[str] = set()
    pending = [query]
    while pending:
        text = pending.pop()
        for name, body in CTE.items():
            if name not in used and _mentions(name, text):
                used.add(name)
                pending.append(body)
    if not used:
        return query.strip()
    parts = ",\n".join(f"{name} AS ({CTE[name]})" for name in CTE if name in used)
    body = query.strip()
    # a query with expressions of its own continues the list
    return f"WITH {parts},\n{body[4:].strip()}" if body.startswith("WITH ") else f"WITH {parts}\n{body}"


def r(expr: str, places: int = 2) -> str:
    """SQL for rounding half away from zero through a decimal, as DOUBLE."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def re_(expr: str, places: int = 2) -> str:
    """SQL for rounding half to even through a decimal, as DOUBLE."""
    return f"CAST(round_even(CAST({expr} AS DECIMAL(38,10)), {places}) AS DOUBLE)"
