"""Bitmaps of customers: numbers beyond one bucket, hot customers, gaps, and missing ids."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordertrail.operators import actives
from ordertrail.session import stored


@pytest.fixture(scope="module")
def tables(spark):
    """70,000 persons in three buckets; one has a third of the orders."""
    customers = spark.range(70_001).selectExpr(
        "id AS customer_id", "CASE WHEN id < 70000 THEN concat('u', lpad(id, 6, '0')) END AS customer_unique_id")
    fact = spark.range(30_000).selectExpr(
        "id AS order_id", "CASE WHEN id % 3 = 0 THEN 69999 WHEN id % 3 = 1 THEN id * 7 % 70001 END AS customer_id",
        "CASE WHEN id % 11 = 0 THEN 'canceled' ELSE 'delivered' END AS order_status",
        "CASE WHEN id % 13 > 0 THEN TIMESTAMP_NTZ '2017-11-20 10:00:00' + make_interval(0, CAST(id % 9 + CAST(id % 9 > 4 AS INT) AS INT)) END "
        "AS order_purchase_timestamp")
    numbers = actives.customer_numbers(customers)
    pairs = stored(actives.numbered_months(fact, customers, numbers))
    return customers, fact, numbers, pairs, stored(actives.bitmaps(pairs, "month"))


def months(tables):
    customers, fact = tables[0].toPandas(), tables[1].toPandas()
    own = dict(zip(customers.customer_id, customers.customer_unique_id))
    out = {}
    for r in fact.itertuples():
        if r.order_status == "delivered" and r.order_purchase_timestamp == r.order_purchase_timestamp and r.customer_id == r.customer_id:
            person = own[int(r.customer_id)]
            if person:
                out.setdefault((r.order_purchase_timestamp.year, r.order_purchase_timestamp.month), set()).add(person)
    return out


def test_numbers_have_no_gaps(tables):
    numbers = tables[2].agg(F.count("*"), F.countDistinct("number"), F.min("number"), F.max("number")).first()
    assert tuple(numbers) == (70_000, 70_000, 0, 69_999)


def test_months_and_windows(tables):
    sets = months(tables)
    active = tables[4]
    assert active.select("bucket").distinct().count() == 3
    name = lambda m: f"{m[0]}-{m[1]:02d}"
    assert dict(rows(actives.monthly_actives(active))) == {name(m): len(s) for m, s in sets.items()}
    found = dict(rows(actives.rolling_actives(active, 3)))
    count = lambda m: m[0] * 12 + m[1]
    assert found == {name(m): len(set().union(*(s for o, s in sets.items() if 0 <= count(m) - count(o) < 3))) for m in sets}
    assert rows(actives.rolling_actives(active, 1)) == rows(actives.monthly_actives(active))


def test_retention(tables):
    sets = months(tables)
    count = lambda m: m[0] * 12 + m[1]
    first = {p: min(m for m, s in sets.items() if p in s) for p in set().union(*sets.values())}
    expected = {}
    for m, s in sets.items():
        for p in s:
            key = (f"{first[p][0]}-{first[p][1]:02d}", count(m) - count(first[p]))
            expected[key] = expected.get(key, 0) + 1
    found = {(r["cohort_month"], r["age_months"]): r["active_customers"] for r in actives.retention(tables[4], tables[3]).collect()}
    assert found == expected


def test_nobody(spark, tables):
    nobody = actives.bitmaps(tables[3].where("false"), "month")
    assert rows(actives.monthly_actives(nobody)) == rows(actives.rolling_actives(nobody)) == []
    with pytest.raises(ValueError):
        actives.rolling_actives(nobody, 0)
    one = spark.createDataFrame([(0, datetime.date(2020, 1, 1))], "number long, month date")
    assert rows(actives.rolling_actives(actives.bitmaps(one, "month"))) == [("2020-01", 1)]
