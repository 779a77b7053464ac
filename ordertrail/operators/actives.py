"""Distinct active customers of any set of months, from one small table of bitmaps.

Every customer has a number without gaps, and a month's customers are a bitmap per 32,768 numbers. Bitmaps of months are
merged by OR, so distinct customers of a quarter, a year or a rolling window follow from the table without the orders:
counts of months cannot be added up, bitmaps can.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import percent, year_month
from ..session import stored
from .ordered import running_totals


def customer_numbers(customers: DataFrame, person: str = "customer_unique_id") -> DataFrame:
    """(person, number): numbers from 0 without gaps, in the order of the ids; NULL has none."""
    distinct = customers.select(person).where(F.col(person).isNotNull()).distinct().withColumn("one", F.lit(1).cast("bigint"))
    return running_totals(distinct, [person], ["one"]).select(person, F.col("before_one").alias("number"))


def numbered_months(fact: DataFrame, customers: DataFrame, numbers: DataFrame, person: str = "customer_unique_id") -> DataFrame:
    """(number, month) of all delivered orders; repeated ones are left to the bitmaps, which do not count them twice."""
    numbered = stored(customers.select("customer_id", person).join(numbers, person).select("customer_id", "number"), "numbered")
    bought = fact.where((F.col("order_status") == "delivered") & F.col("order_purchase_timestamp").isNotNull()).select(
        "customer_id", F.trunc("order_purchase_timestamp", "month").alias("month"))
    return bought.join(numbered, "customer_id").select("number", "month")


def bitmaps(rows: DataFrame, *by: str) -> DataFrame:
    """(by, bucket, bitmap) of the numbers of ``rows``. Made in each task before the shuffle, which moves 4 KB a bucket and
    task at most, whoever buys how often."""
    at = F.col("number") + 1  # buckets count from 1
    return rows.groupBy(*by, F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))


def monthly_actives(active: DataFrame) -> DataFrame:
    """Distinct customers per calendar month: order_month, active_customers."""
    return active.groupBy("month").agg(F.sum(F.bitmap_count("bitmap")).alias("active_customers")).select(
        year_month("month").alias("order_month"), "active_customers")


def rolling_actives(active: DataFrame, months: int = 3) -> DataFrame:
    """Distinct customers of each month with orders and the ``months`` - 1 before it."""
    if months < 1:
        raise ValueError("a window has a month at least")
    windows = active.select("bucket", "bitmap", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(months - 1)), lambda i: F.add_months("month", i))).alias("month"))
    # a row per month
    there = windows.join(F.broadcast(active.select("month").distinct()), "month", "left_semi")
    merged = there.groupBy("month", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return monthly_actives(merged)


def retention(active: DataFrame, rows: DataFrame) -> DataFrame:
    """Customers per month of their first order and month after it: cohort_month, age_months, active_customers, cohort_size,
    retention_pct; ages without customers have no row.

    The customers of a cohort and a month are as many as both have, less those of the two bitmaps merged.
    """
    first = rows.groupBy("number").agg(F.min("month").alias("cohort"))
    cohorts = stored(bitmaps(first, "cohort"), "cohorts")
    sizes = cohorts.groupBy("cohort").agg(F.sum(F.bitmap_count("bitmap")).alias("cohort_size"))
    own, later = F.bitmap_count("bitmap"), F.bitmap_count("other")
    pairs = cohorts.join(active.select("bucket", "month", F.col("bitmap").alias("other")), "bucket").where("month >= cohort")
    sides = F.array(F.col("bitmap"), F.col("other"))
    merged = pairs.select("cohort", "month", "bucket", (own + later).alias("both"), F.explode(sides).alias("side")).groupBy(
        "cohort", "month", "bucket").agg(F.first("both").alias("both"), F.bitmap_count(F.bitmap_or_agg("side")).alias("either"))
    counted = merged.groupBy("cohort", "month").agg(F.sum(F.col("both") - F.col("either")).alias("active_customers"))
    age = (F.year("month") - F.year("cohort")) * 12 + F.month("month") - F.month("cohort")
    return counted.where("active_customers > 0").join(sizes, "cohort").select(
        year_month("cohort").alias("cohort_month"), age.alias("age_months"), "active_customers", "cohort_size",
        percent("active_customers", "cohort_size").alias("retention_pct"))
