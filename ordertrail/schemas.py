"""Schemas of the raw files and of the star tables.

The column names, widths and keys below are fixed values: they are the data contract.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

_TS = "timestamp_ntz"

# Raw files. Order timestamps arrive as text and are parsed leniently by the fact builder.
RAW = {
    "customers": "customer_id string, customer_unique_id string, customer_city string, customer_state string",
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
              "order_approved_at string, order_delivered_carrier_date string, "
              "order_delivered_customer_date string, order_estimated_delivery_date string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
                   "price decimal(10,2), freight_value decimal(10,2)",
    "payments": "order_id string, payment_type string, payment_installments int, payment_value decimal(10,2)",
    "reviews": "order_id string, review_score int",
    "products": "product_id string, product_category_name string, product_weight_g decimal(10,2), "
                "product_length_cm decimal(10,2), product_height_cm decimal(10,2), product_width_cm decimal(10,2)",
    "sellers": "seller_id string, seller_city string, seller_state string",
    "translation": "product_category_name string, product_category_name_english string",
}

# raw files whose unused columns hold free text with line breaks
FREE_TEXT = {"reviews"}

LIFECYCLE_TIMESTAMPS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

# Star tables: column -> type with the stated width; ``type_conform`` enforces the widths.
STAR = {
    "dim_customers": {
        "customer_id": "varchar(50)",
        "customer_unique_id": "varchar(50)",
        "customer_city": "varchar(100)",
        "customer_state": "char(2)",
    },
    "dim_products": {
        "product_id": "varchar(50)",
        "product_category_name": "varchar(100)",
        "product_category_en": "varchar(100)",
        "product_weight_g": "decimal(10,2)",
        "product_length_cm": "decimal(10,2)",
        "product_height_cm": "decimal(10,2)",
        "product_width_cm": "decimal(10,2)",
    },
    "dim_sellers": {
        "seller_id": "varchar(50)",
        "seller_city": "varchar(100)",
        "seller_state": "char(2)",
    },
    "dim_payments": {
        "order_id": "varchar(50)",
        "payment_type": "varchar(50)",
        "payment_installments": "int",
        "payment_value": "decimal(10,2)",
    },
    "fact_orders": {
        "order_id": "varchar(50)",
        "customer_id": "varchar(50)",
        "product_id": "varchar(50)",
        "seller_id": "varchar(50)",
        **{c: _TS for c in LIFECYCLE_TIMESTAMPS},
        "order_status": "varchar(50)",
        "price": "decimal(10,2)",
        "freight_value": "decimal(10,2)",
        "order_revenue": "decimal(10,2)",
        "purchase_year": "int",
        "purchase_month": "int",
        "purchase_day_of_week": "int",
        "delivery_delay_days": "decimal(10,2)",
        "review_score": "int",
    },
}

PRIMARY_KEY = {
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "dim_sellers": "seller_id",
    "dim_payments": "order_id",
    "fact_orders": "order_id",
}

NOT_NULL = {
    "dim_customers": ["customer_id", "customer_unique_id"],
    "dim_products": ["product_id"],
    "dim_sellers": ["seller_id"],
    "dim_payments": ["order_id"],
    "fact_orders": ["order_id"],
}


def raw_schema(name: str) -> StructType:
    """Read schema of a raw file."""
    return StructType.fromDDL(RAW[name])


def star_schema(name: str) -> StructType:
    """Spark schema of a star table; widths of text are checks, not types."""
    fields = (
        f"{col} {'string' if kind.startswith(('varchar', 'char')) else kind}"
        for col, kind in STAR[name].items()
    )
    return StructType.fromDDL(", ".join(fields))
