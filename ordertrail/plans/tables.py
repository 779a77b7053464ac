"""The raw order tables, derived from the bundled star-schema tables, and the star built from them.

The bundled tables have no order lifecycle, reviews or payments; these views give each of them a
deterministic stand-in. ``oracle_tables`` holds the same definitions as SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import star
from ..session import scratch_path, stored

# Lines of one order in their order; the line number alone repeats within an order.
LINE_ORDER = ["order_item_id", "product_id", "seller_id"]
SPLIT_DATE = "1995-06-16"
FORWARD_CUT = "2000-01-01"

# Status by order key modulo 20; the rest is delivered.
STATUS_BY_REMAINDER = {0: "created", 1: "approved", 2: "invoiced", 3: "processing", 4: "shipped",
                       5: "canceled", 6: "canceled", 7: "unavailable"}


def _status(key: str) -> str:
    cases = " ".join(f"WHEN {key} % 20 = {rest} THEN '{name}'" for rest, name in STATUS_BY_REMAINDER.items())
    return f"CASE WHEN {key} % 97 = 0 THEN NULL {cases} ELSE 'delivered' END"


# what is written once per application and folder
_once: dict[tuple[str, str, str], DataFrame] = {}
_models: dict[tuple[str, str, str], str] = {}


class Tables:
    """Lazy frames over one folder of bundled tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    def once(self, name: str, build) -> DataFrame:
        """A table that several queries show and that is dear to make: written by the first, read by the others."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _once:
            _once[key] = stored(build(), name)
        return _once[key]

    def model(self, name: str, kind, fit):
        """A fitted model that several queries use: saved by the first, loaded by the others."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _models:
            path = scratch_path(self.spark, name)
            fit().save(self.spark, path)
            _models[key] = path
        return kind.load(self.spark, _models[key])

    # raw tables

    def _with_state(self, table: str, nation_key: str) -> DataFrame:
        nations = self.source("nation").selectExpr(f"n_nationkey AS {nation_key}", "n_name AS state")
        return self.source(table).join(nations, nation_key, "left")

    @cached_property
    def customers(self) -> DataFrame:
        return self._with_state("customer", "c_nationkey").selectExpr(
            "c_custkey AS customer_id", "c_custkey div 3 AS customer_unique_id", "c_mktsegment AS customer_city",
            "state AS customer_state")

    @cached_property
    def sellers(self) -> DataFrame:
        return self._with_state("supplier", "s_nationkey").selectExpr(
            "s_suppkey AS seller_id", "s_name AS seller_city", "state AS seller_state")

    @cached_property
    def products(self) -> DataFrame:
        return self.source("part").selectExpr(
            "p_partkey AS product_id", "p_type AS product_category_name",
            "CAST(p_size AS DECIMAL(10,2)) AS product_weight_g",
            "CAST(p_retailprice AS DECIMAL(10,2)) AS product_length_cm",
            "CAST(p_size AS DECIMAL(10,2)) AS product_height_cm", "CAST(p_size AS DECIMAL(10,2)) AS product_width_cm")

    @cached_property
    def translation(self) -> DataFrame:
        kinds = self.source("part").select("p_type").filter("p_type <> 'PROMO'").distinct()
        return kinds.selectExpr("p_type AS product_category_name", "lower(p_type) AS product_category_name_english")

    @cached_property
    def orders(self) -> DataFrame:
        shipped = self.source("lineitem").groupBy("l_orderkey").agg(
            F.expr("min(l_shipdate) AS carrier"),
            F.expr("max(l_shipdate + make_dt_interval(0, l_linenumber)) AS delivered"))
        placed = self.source("orders").withColumnRenamed("o_orderkey", "l_orderkey")
        return placed.join(shipped, "l_orderkey", "left").selectExpr(
            "l_orderkey AS order_id", "o_custkey AS customer_id", f"{_status('l_orderkey')} AS order_status",
            "o_orderdate AS order_purchase_timestamp", "o_orderdate + INTERVAL 6 HOURS AS order_approved_at",
            "carrier AS order_delivered_carrier_date", "delivered AS order_delivered_customer_date",
            "o_orderdate + INTERVAL '30 12' DAY TO HOUR AS order_estimated_delivery_date")

    @cached_property
    def order_items(self) -> DataFrame:
        price, tax = "CAST(l_extendedprice AS DECIMAL(10,2))", "CAST(l_tax AS DECIMAL(10,2))"
        return self.source("lineitem").selectExpr(
            "l_orderkey AS order_id", "l_linenumber AS order_item_id", "l_partkey AS product_id",
            "l_suppkey AS seller_id", f"{price} AS price", f"CAST({price} * {tax} AS DECIMAL(10,2)) AS freight_value")

    @cached_property
    def payments(self) -> DataFrame:
        price, off = "CAST(l_extendedprice AS DECIMAL(10,2))", "CAST(l_discount AS DECIMAL(10,2))"
        return self.source("lineitem").selectExpr(
            "l_orderkey AS order_id", "l_returnflag AS payment_type", "l_linenumber AS payment_installments",
            f"CAST({price} * (CAST(1 AS DECIMAL(10,2)) - {off}) AS DECIMAL(10,2)) AS payment_value")

    @cached_property
    def reviews(self) -> DataFrame:
        return self.source("lineitem").selectExpr(
            "l_orderkey AS order_id", "1 + CAST(l_quantity AS INT) % 5 AS review_score")

    @property
    def raw(self) -> dict[str, DataFrame]:
        names = ["customers", "orders", "order_items", "payments", "reviews", "products", "sellers", "translation"]
        return {n: getattr(self, n) for n in names}

    # star tables, as plans over the raw ones

    @cached_property
    def dim_customers(self) -> DataFrame:
        return star.dim_customers(self.customers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return star.dim_products(self.products, self.translation)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return star.dim_sellers(self.sellers)

    @cached_property
    def dim_payments(self) -> DataFrame:
        return star.dim_payments(self.payments)

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_orders(self.orders, self.order_items, self.reviews, LINE_ORDER)

    @property
    def star(self) -> dict[str, DataFrame]:
        return {"dim_customers": self.dim_customers, "dim_products": self.dim_products,
                "dim_sellers": self.dim_sellers, "dim_payments": self.dim_payments, "fact_orders": self.fact}

    # dimensions as written tables, for joins at order grain

    @cached_property
    def stored_customers(self) -> DataFrame:
        return stored(self.dim_customers, "dim_customers")

    @cached_property
    def stored_products(self) -> DataFrame:
        return stored(self.dim_products, "dim_products")

    @cached_property
    def stored_sellers(self) -> DataFrame:
        return stored(self.dim_sellers, "dim_sellers")
