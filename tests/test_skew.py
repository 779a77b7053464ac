"""One key holds a third of all rows, and NULL keys are frequent: results stay whole."""

import math

import numpy as np
import pandas as pd
import pytest
from conftest import rows

from ordertrail.operators import evaluate, quality, reports, rfm, star
from ordertrail.operators import ordered
from ordertrail.operators.ordered import exact_quantiles, running_totals

N = 6000


@pytest.fixture(scope="module")
def data(spark):
    orders = spark.range(N).selectExpr(
        "id AS order_id",
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 29 = 1 THEN NULL ELSE id % 400 END AS customer_id",
        "CASE WHEN id % 3 = 1 THEN 5 WHEN id % 31 = 0 THEN NULL ELSE id % 90 END AS product_id",
        "id % 11 AS seller_id",
        "CASE WHEN id % 5 = 0 THEN 'canceled' ELSE 'delivered' END AS order_status",
        "CAST(CASE WHEN id % 17 <> 0 THEN (id % 1000) / 4 END AS DECIMAL(10,2)) AS order_revenue",
        "TIMESTAMP_NTZ '2018-01-01 00:00:00' + make_dt_interval(CAST(id % 300 AS INT)) AS order_purchase_timestamp")
    customers = spark.range(380).selectExpr(
        "id AS customer_id", "id div 2 AS customer_unique_id", "concat('S', id % 6) AS customer_state")
    return orders, customers, orders.toPandas(), customers.toPandas()


def test_cancellation_by_state(spark, data):
    orders, customers, po, pc = data
    out = reports.cancellation_by_state(orders, customers, min_orders=10).collect()
    joined = po.dropna(subset="customer_id").merge(pc, on="customer_id")
    expected = joined.groupby("customer_state").agg(
        n=("order_id", "count"), c=("order_status", lambda s: (s == "canceled").sum()))
    assert {r["customer_state"]: (r["total_orders"], r["canceled_orders"]) for r in out} == {
        k: (v.n, v.c) for k, v in expected.iterrows()}


def test_rfm(spark, data):
    orders, customers, po, pc = data
    out = {r["customer_unique_id"]: (r["recency"], r["frequency"], r["monetary"])
           for r in rfm.rfm(orders, customers).collect()}
    kept = po[(po.order_status == "delivered") & po.order_revenue.notna()].merge(pc, on="customer_id")
    newest = kept.order_purchase_timestamp.max() + pd.Timedelta(days=1)
    expected = kept.groupby("customer_unique_id").agg(
        last=("order_purchase_timestamp", "max"), n=("order_id", "count"),
        m=("order_revenue", lambda s: float(s.sum())))
    assert out == {k: ((newest - v["last"]).days, v.n, v.m) for k, v in expected.iterrows()}


def test_foreign_keys(spark, data):
    orders, customers, po, pc = data
    products = spark.range(80).selectExpr("id AS product_id")
    refs = [("customer_id", customers, False), ("product_id", products, True)]
    ok = po.customer_id.isin(pc.customer_id) & (po.product_id.isin(range(80)) | po.product_id.isna())
    assert rows(quality.fk_filter(orders, refs), "order_id") == sorted(((i,) for i in po[ok].order_id), key=repr)
    report = dict(rows(quality.fk_report(orders, refs)))
    assert report["any"] == (~ok).sum()
    assert report["customer_id"] == (~po.customer_id.isin(pc.customer_id)).sum()


def test_order_with_a_third_of_all_lines(spark):
    lines = spark.range(N).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS order_id", "CAST(id AS INT) AS order_item_id",
        "id % 50 AS product_id", "id % 7 AS seller_id", "CAST(99999.99 AS DECIMAL(10,2)) AS price",
        "CAST(1 AS DECIMAL(10,2)) AS freight_value", "concat('t', id % 3) AS payment_type",
        "1 AS payment_installments", "CAST(99999.99 AS DECIMAL(10,2)) AS payment_value")
    hot = star.items_agg(lines, ["order_item_id"]).filter("order_id = 0").first()
    # wider than the stored column: the sum itself does not overflow
    assert float(hot["price"]) == pytest.approx(99999.99 * N / 3) and hot["product_id"] == 0
    assert star.dim_payments(lines).filter("order_id = 0").first()["payment_type"] == "t0"
    # every order of its own, and the one that holds a third of the lines
    assert star.items_agg(lines, ["order_item_id"]).count() == N - N // 3 + 1


@pytest.mark.parametrize("partitions", [1, 13])
def test_running_totals(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.range(2000).selectExpr("id * 7919 % 2003 AS k", "id % 5 AS v", "concat('g', id % 2) AS g")
        out = running_totals(df, ["k"], ["v"], ["g"]).toPandas().sort_values(["g", "k"])
        expected = out.groupby("g").v.cumsum() - out.v
        assert (out.before_v == expected).all() and len(out) == 2000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_quantiles(spark):
    df = spark.range(1001).selectExpr("CASE WHEN id % 3 = 0 THEN 4 ELSE id * 37 % 101 END AS a",
                                      "CASE WHEN id % 2 = 0 THEN id / 8 END AS b")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = {(r["metric"], r["probability"]): r["value"]
             for r in exact_quantiles(df, ["a", "b"], probabilities).collect()}
    pdf = df.toPandas()
    assert found == {(c, p): pytest.approx(np.quantile(pdf[c].dropna().astype(float), p))
                     for c in ("a", "b") for p in probabilities}


@pytest.mark.parametrize("numbers", [
    [1.0], [2.0, 2.0, 2.0], [float("-inf"), 1.0, 2.0, float("inf")], [1.0, float("nan"), float("inf")], [5e-324, 0.0, 1.0, -5e-324],
    [1.7e308, -1.7e308, 0.0, 1e-300, 1e-290, 1.0], [10.0 ** i for i in range(-40, 40)], [], [None, 3.0, 4.0]])
def test_quantiles_of_odd_numbers(spark, numbers):
    df = spark.createDataFrame([(v,) for v in numbers], "v double").repartition(3)
    found = {r["probability"]: r["value"] for r in exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0]).collect()}
    known = sorted((v for v in numbers if v is not None), key=lambda v: (v != v, v))
    expected = {}
    for p in (0.0, 0.25, 0.5, 1.0) if known else ():
        at = p * (len(known) - 1)
        a, b = known[math.floor(at)], known[math.ceil(at)]
        expected[p] = a if a == b else a + (b - a) * (at - math.floor(at))
    assert found == pytest.approx(expected, nan_ok=True)


def test_quantiles_take_few_scans_and_sort_nothing(spark, monkeypatch):
    scans, real = [], ordered._narrow
    monkeypatch.setattr(ordered, "_narrow", lambda values, seeking: scans.append(values) or real(values, seeking))
    df = spark.range(100_000).selectExpr("exp(id % 9973 / 700D) AS a", "CAST(id AS DOUBLE) AS b")
    found = {(r["metric"], r["probability"]): r["value"] for r in exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.9]).collect()}
    pdf = df.toPandas()
    assert found == {(c, p): pytest.approx(np.quantile(pdf[c], p)) for c in ("a", "b") for p in (0.25, 0.5, 0.9)}
    assert 0 < len(scans) <= 4
    assert "FileScan" in scans[0]._jdf.queryExecution().executedPlan().toString()


def test_auc_with_a_third_of_all_scores_equal(spark):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0.5D ELSE (id * 7919 % 1000) / 1000D END AS churn_probability",
        "CAST(id * 31 % 7 < 3 AS INT) AS churned")
    pdf = df.toPandas()
    ranks = pdf.churn_probability.rank()
    pos = pdf.churned == 1
    expected = (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert evaluate.roc_auc(df).first()["auc"] == pytest.approx(expected)
