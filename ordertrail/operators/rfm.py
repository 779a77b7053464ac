"""Recency, frequency and monetary value per customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import half_even, whole_days
from .onerow import with_overall_max, with_totals
from .ordered import exact_quantiles

RFM = ["recency", "frequency", "monetary"]


def _delivered(fact: DataFrame) -> DataFrame:
    return fact.filter("""order_status = 'delivered' AND order_revenue IS NOT NULL
                          AND order_purchase_timestamp IS NOT NULL""")


def rfm_base(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered orders that have revenue and a purchase time, with their customer."""
    return (
        _delivered(fact)
        .join(customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id")
        .select("customer_id", "customer_unique_id", "customer_state", "order_purchase_timestamp",
                "order_revenue", "order_status")
    )


def rfm(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer: whole days since the last order, number of orders, revenue.

    Days are counted from the day after the last order of all. Orders are summed per customer id
    before they meet the customer table, so a very frequent buyer is one row in that join.
    """
    per_id = (
        _delivered(fact).filter("customer_id IS NOT NULL").groupBy("customer_id")
        .agg(*map(F.expr, ["max(order_purchase_timestamp) AS last", "count(*) AS n", "sum(order_revenue) AS revenue"]))
    )
    persons = customers.select("customer_id", "customer_unique_id").filter("customer_unique_id IS NOT NULL")
    per_person = (
        per_id.join(persons, "customer_id").groupBy("customer_unique_id")
        .agg(*map(F.expr, ["max(last) AS last", "sum(n) AS frequency", "sum(revenue) AS monetary"]))
    )
    return with_overall_max(per_person, "last", "newest").select(
        "customer_unique_id",
        whole_days("newest + INTERVAL 1 DAY", "last").cast("int").alias("recency"),
        "frequency",
        F.expr("CAST(monetary AS DOUBLE) AS monetary"),
    )


def describe(df: DataFrame, columns: Sequence[str] = tuple(RFM), places: int = 2) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column, one row each."""
    parts = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in columns])
    moments = (
        df.select(F.inline(parts)).groupBy("metric")
        .agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
             F.min("v").alias("min"), F.max("v").alias("max"))
    )
    quartiles = (
        exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        .groupBy("metric").pivot("probability", [0.25, 0.5, 0.75]).agg(F.first("value"))
        .toDF("metric", "p25", "p50", "p75")
    )
    shown = [half_even(F.col(c).cast("decimal(38,10)"), places).cast("double").alias(c)
             for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]]
    return moments.join(quartiles, "metric", "left").select("metric", "count", *shown)


def zscore(df: DataFrame, columns: Sequence[str] = tuple(RFM), suffix: str = "_z") -> DataFrame:
    """Standardise with the mean and the population deviation; a constant column becomes 0."""
    moments = [f(F.col(c)).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    wide = with_totals(df, *moments)
    scaled = [
        ((F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}")))
        .alias(c + suffix)
        for c in columns
    ]
    return wide.select(*df.columns, *scaled)
