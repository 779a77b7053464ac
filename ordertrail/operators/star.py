"""Builders of the star schema: four dimensions and the order fact.

Everything is aggregated to order grain before it is joined, and a join to an aggregate of the same
key reuses the aggregate's partitioning. Reports that need only order columns lose the joins
altogether, since Catalyst drops a left join whose other side is unique and unused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_parts, first_nonnull, half_even, most_frequent, parse_ts, sum_or_zero, whole_days
from ..schemas import LIFECYCLE_TIMESTAMPS, STAR
from ..session import stored
from .dedup import dedup_first


def dim_customers(customers: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    return _dimension(customers, list(STAR["dim_customers"]), "customer_id", order_by)


def dim_sellers(sellers: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    return _dimension(sellers, list(STAR["dim_sellers"]), "seller_id", order_by)


def _dimension(raw: DataFrame, columns: list[str], key: str, order_by: Sequence[str] | None) -> DataFrame:
    extra = [c for c in order_by or [] if c not in columns]
    return dedup_first(raw.selectExpr(*columns, *extra), key, order_by).drop(*extra)


def dim_products(products: DataFrame, translation: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Products with the English category; a category without translation gets NULL.

    The translation is made unique first, so that a repeated line cannot multiply products, and written: then its
    size decides whether it is broadcast, and a category of very many products can be split if it is not.
    """
    names = stored(dedup_first(
        translation.selectExpr("product_category_name", "product_category_name_english AS product_category_en"),
        "product_category_name",
    ), "translation")
    raw = [c for c in STAR["dim_products"] if c != "product_category_en"]
    unique = _dimension(products, raw, "product_id", order_by)
    return unique.join(names, "product_category_name", "left").selectExpr(*STAR["dim_products"])


def dim_payments(payments: DataFrame) -> DataFrame:
    """One row per order: most frequent type, largest number of installments, total value.

    An order whose payment types are all NULL keeps its row, with a NULL type.
    """
    return (
        payments.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            most_frequent("payment_type").alias("payment_type"),
            F.max("payment_installments").alias("payment_installments"),
            sum_or_zero("payment_value").alias("payment_value"),
        )
    )


def items_agg(order_items: DataFrame, line_order: Sequence[str]) -> DataFrame:
    """One row per order: first product and seller in line order, total price and freight."""
    return (
        order_items.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            first_nonnull("product_id", line_order).alias("product_id"),
            first_nonnull("seller_id", line_order).alias("seller_id"),
            sum_or_zero("price").alias("price"),
            sum_or_zero("freight_value").alias("freight_value"),
        )
    )


def review_agg(reviews: DataFrame) -> DataFrame:
    """One row per order: mean score, rounded half to even."""
    return (
        reviews.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(half_even(F.avg("review_score")).cast("int").alias("review_score"))
    )


def fact_orders(orders: DataFrame, order_items: DataFrame, reviews: DataFrame,
                line_order: Sequence[str]) -> DataFrame:
    """One row per order with lifecycle times, money, date parts, delivery delay and review score.

    Money keeps the width of its sum here; the stored width is enforced when the table is written.
    """
    parsed = orders.withColumns({c: parse_ts(c) for c in LIFECYCLE_TIMESTAMPS})
    year, month, weekday = date_parts("order_purchase_timestamp")
    delay = whole_days("order_delivered_customer_date", "order_estimated_delivery_date")
    return (
        parsed.join(items_agg(order_items, line_order), "order_id", "left")
        .join(review_agg(reviews), "order_id", "left")
        .withColumns({
            "order_revenue": F.expr("price + freight_value"),
            "purchase_year": year,
            "purchase_month": month,
            "purchase_day_of_week": weekday,
            "delivery_delay_days": delay.cast("decimal(10,2)"),
        })
        .selectExpr(*STAR["fact_orders"])
    )
