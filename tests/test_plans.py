"""Shapes of the physical plans that matter at scale."""

import pytest

from ordertrail.operators import star
from ordertrail.operators.churn import churn_base
from ordertrail.operators.members import keep_members
from ordertrail.plans import registered
from ordertrail.session import stored

REPORTS = ["funnel_conversion", "revenue_leakage", "revenue_by_status", "cancellation_by_state",
           "cancellation_by_category_top10", "monthly_cohort", "delivery_delay_by_state"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as for tables that are too large to broadcast."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def test_funnel_reads_orders_once(spark, folder):
    text = plan(registered()["funnel_conversion"](spark, folder))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_reports_have_no_python_and_no_nested_loop(spark, folder, no_broadcast):
    for name in REPORTS:
        text = plan(registered()[name](spark, folder))
        assert "Python" not in text and "ArrowEval" not in text, name
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_foreign_key_filter_has_no_nested_loop(spark, folder, no_broadcast):
    text = plan(registered()["fk_filter"](spark, folder))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert text.count("LeftSemi") == 3 and "LeftAnti" not in text


def test_dimension_reports_aggregate_before_the_join(spark, folder, no_broadcast):
    text = plan(registered()["cancellation_by_state"](spark, folder))
    join = text.index("SortMergeJoin [customer_id")
    assert "partial_count(1)" in text[join:] and "partial_sum(n" in text[:join]


def test_rfm_runs_its_aggregation_once(spark, folder, no_broadcast):
    df = registered()["rfm"](spark, folder)
    df.collect()
    assert "ReusedExchange" in plan(df)
    assert plan(df).split("Initial Plan")[0].count("FileScan") == 4


def test_no_global_sort_in_one_task(spark, folder, no_broadcast):
    """Ranking and running totals never put customer rows into a single partition."""
    for name in ["label_codes", "roc_curve", "rfm_describe"]:
        text = plan(registered()[name](spark, folder))
        for line in text.splitlines():
            # the windows without a key run over one row per range
            assert not ("Window" in line and "before" in line), line


@pytest.fixture()
def small_skew_limits(spark, no_broadcast):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.shuffle.partitions": "16"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def hot_facts(spark, rows=60_000):
    """A third of all orders is of one customer and one product."""
    return spark.range(rows).repartition(8).selectExpr(
        "id AS order_id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS customer_id",
        "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 900 END AS product_id", "'delivered' AS order_status",
        "TIMESTAMP_NTZ '2018-01-01 00:00:00' + make_dt_interval(CAST(id % 300 AS INT)) AS order_purchase_timestamp",
        "CAST(id % 100 AS DECIMAL(10,2)) AS order_revenue", "CAST(1 AS DECIMAL(10,2)) AS price",
        "CAST(1 AS DECIMAL(10,2)) AS freight_value", "CAST(id % 5 AS INT) AS review_score",
        "CAST(id % 9 AS DECIMAL(10,2)) AS delivery_delay_days", "2018 AS purchase_year",
        "CAST(id % 12 AS INT) AS purchase_month", "CAST(id % 7 AS INT) AS purchase_day_of_week")


def test_membership_splits_a_hot_key(spark, small_skew_limits):
    facts = hot_facts(spark)
    # a dimension that comes partitioned by its key, as the builders return it
    members = spark.range(1000).groupBy("id").count().selectExpr("id AS customer_id")
    kept = keep_members(facts, "customer_id", members)
    assert kept.collect() and "skew=true" in plan(kept)
    assert kept.count() == 60_000


def test_churn_base_splits_hot_customers_and_products(spark, small_skew_limits):
    facts = hot_facts(spark)
    customers = stored(spark.range(1000).selectExpr("id AS customer_id", "id div 3 AS customer_unique_id",
                                                    "concat('S', id % 20) AS customer_state"))
    products = stored(spark.range(900).selectExpr("id AS product_id", "concat('c', id % 7) AS product_category_en"))
    payments = spark.range(60_000).selectExpr("id AS order_id", "'card' AS payment_type")
    base = churn_base(facts, customers, products, payments)
    assert len(base.collect()) == 60_000
    assert plan(base).split("Initial Plan")[0].count("skew=true") >= 2


def test_products_split_a_hot_category(spark, small_skew_limits):
    products = spark.range(60_000).repartition(8).selectExpr(
        "id AS product_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 > 0 THEN concat('c', id % 100) END AS product_category_name",
        *[f"CAST(id % 9 AS DECIMAL(10,2)) AS product_{c}" for c in ("weight_g", "length_cm", "height_cm", "width_cm")])
    translation = spark.range(100).selectExpr("IF(id = 0, 'hot', concat('c', id)) AS product_category_name",
                                              "concat('e', id) AS product_category_name_english")
    # tables this small would otherwise come from one map task, which leaves nothing to split
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = star.dim_products(products, translation)
        found.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found.collect()) == 60_000 and "skew=true" in plan(found)
    assert found.where("product_category_en = 'e0'").count() == 20_000


def test_foreign_key_report_evaluates_the_fact_once(spark, folder, no_broadcast):
    # one left join with the written keys of each dimension
    text = plan(registered()["fk_report"](spark, folder))
    assert text.count("LeftOuter") == 3 + 1 and "NestedLoop" not in text  # the fact has one of its own


def test_silhouette_reads_written_customers(spark, folder):
    text = plan(registered()["silhouette"](spark, folder))
    assert "lineitem" not in text and text.split("Initial Plan")[0].count("FileScan") == 2
