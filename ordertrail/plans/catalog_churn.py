"""Churn label, customer features, split, and the announced extensions."""

from pyspark.sql import functions as F

from ..operators import churn, extensions
from ..operators.segments import assign_segments
from ..session import stored
from .catalog_customers import _fixed
from .oracle_tables import r
from .registry import query, rounded
from .tables import FORWARD_CUT, SPLIT_DATE, Tables

_BASE_MONEY = ["order_revenue", "price", "freight_value", "delivery_delay_days"]
_FLOATS = ["avg_order_value", "avg_review_score", "avg_delivery_delay", "avg_freight", "purchase_month", "purchase_dow"]
_REPLACE = "REPLACE (" + ", ".join(f"{r(c, 6)} AS {c}" for c in _FLOATS) + ")"


def base(t: Tables):
    return churn.churn_base(t.fact, t.stored_customers, t.stored_products, t.dim_payments)


def features(t: Tables):
    return churn.customer_features(base(t))


def split(t: Tables):
    return churn.time_split(features(t), SPLIT_DATE)


def with_fixed_score(customers):
    """A fixed score per customer, so that evaluation can be checked without a model."""
    score = (F.col("customer_unique_id") * 7919 % 1000).cast("double") / 1000
    return customers.withColumns({"churn_probability": score, "churn_prediction": (score >= 0.5).cast("int")})


def scored(t: Tables):
    return with_fixed_score(churn.churn_label(base(t))).select(
        "customer_unique_id", "churned", "churn_probability", "churn_prediction")


_SPLIT_SQL = f"""
    SELECT *, CASE WHEN first_purchase < TIMESTAMP '{SPLIT_DATE} 00:00:00' THEN 'train' ELSE 'test' END AS split
    FROM features"""


@query("churn_base", f"""
    SELECT * REPLACE ({", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _BASE_MONEY)}) FROM churn_base""")
def _(t: Tables):
    return base(t)


@query("churn_label", "SELECT customer_unique_id, last_purchase, churned FROM churn_label")
def _(t: Tables):
    return churn.churn_label(base(t))


@query("churn_rate", f"""
    SELECT {r("avg(churned) * 100", 6)} AS churn_rate_pct, count(*) FILTER (WHERE churned = 1) AS churned,
           count(*) FILTER (WHERE churned = 0) AS active FROM churn_label""")
def _(t: Tables):
    return rounded(churn.churn_rate(churn.churn_label(base(t))))


@query("label_rate", f"""
    SELECT customer_state, {r("avg(churned) * 100", 6)} AS rate, CAST(sum(churned) AS BIGINT) AS churned
    FROM customer_profile GROUP BY customer_state""")
def _(t: Tables):
    profile = churn.customer_profile(base(t))
    return rounded(profile.groupBy("customer_state").agg(
        (F.avg("churned") * 100).alias("rate"), F.sum("churned").alias("churned")))


@query("customer_profile", f"SELECT * {_REPLACE} FROM customer_profile")
def _(t: Tables):
    return rounded(churn.customer_profile(base(t)), 6, *_FLOATS)


@query("customer_features", f"SELECT * {_REPLACE} FROM features")
def _(t: Tables):
    return rounded(features(t), 6, *_FLOATS)


@query("label_encode", """
    SELECT customer_unique_id, customer_state, top_category, top_payment FROM features""")
def _(t: Tables):
    return churn.label_encode(churn.customer_profile(base(t))).select("customer_unique_id", *churn.CATEGORICAL)


@query("label_codes", 'SELECT col AS "column", val AS value, code FROM codes')
def _(t: Tables):
    return churn.label_codes(churn.customer_profile(base(t)), churn.CATEGORICAL)


@query("time_split", f"SELECT customer_unique_id, churned, first_purchase, split FROM ({_SPLIT_SQL})")
def _(t: Tables):
    return split(t).select("customer_unique_id", "churned", "first_purchase", "split")


@query("split_stats", f"""
    SELECT split, count(*) AS customers, {r("avg(churned) * 100", 6)} AS churn_rate_pct FROM ({_SPLIT_SQL})
    GROUP BY split""")
def _(t: Tables):
    return rounded(churn.split_stats(split(t)))


@query("class_weight", f"""
    SELECT {r("count(*) FILTER (WHERE churned = 0) / count(*) FILTER (WHERE churned = 1)", 6)} AS scale_pos_weight
    FROM ({_SPLIT_SQL}) WHERE split = 'train'""")
def _(t: Tables):
    return rounded(churn.class_weight(split(t).filter("split = 'train'")))


@query("nan_policy", f"""
    WITH g AS (SELECT * REPLACE (CASE WHEN top_category = 0 THEN NULL ELSE avg_freight END AS avg_freight)
               FROM ({_SPLIT_SQL}))
    SELECT customer_unique_id, split, top_category,
           {r("coalesce(avg_freight, (SELECT avg(avg_freight) FROM g WHERE split = 'train'))", 6)} AS avg_freight,
           CAST(avg_freight IS NULL AS INTEGER) AS avg_freight_missing FROM g""")
def _(t: Tables):
    gaps = split(t).select(
        "customer_unique_id", "split", "top_category",
        F.when(F.col("top_category") != 0, F.col("avg_freight")).alias("avg_freight"))
    return rounded(churn.nan_policy(gaps, ["avg_freight"], F.col("split") == "train"))


@query("cohort_retention", f"""
    WITH m AS (SELECT DISTINCT customer_unique_id, date_trunc('month', order_purchase_timestamp) AS month
               FROM fact_orders JOIN dim_customers USING (customer_id)
               WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL),
         c AS (SELECT customer_unique_id, min(month) AS cohort FROM m GROUP BY customer_unique_id),
         n AS (SELECT cohort, CAST((year(month) - year(cohort)) * 12 + month(month) - month(cohort) AS INTEGER)
                      AS age_months, count(*) AS active_customers FROM m JOIN c USING (customer_unique_id) GROUP BY ALL),
         s AS (SELECT cohort, count(*) AS cohort_size FROM c GROUP BY cohort)
    SELECT strftime(cohort, '%Y-%m') AS cohort_month, age_months, active_customers, cohort_size,
           {r("active_customers * 100.0 / cohort_size")} AS retention_pct FROM n JOIN s USING (cohort)""")
def _(t: Tables):
    return extensions.cohort_retention(t.fact, t.dim_customers)


@query("revenue_at_risk", f"""
    WITH d AS (SELECT floor((epoch_us(max(order_purchase_timestamp)) - epoch_us(min(order_purchase_timestamp)))
                            / 86400000000) + 1 AS days FROM fact_orders WHERE order_status = 'delivered')
    SELECT segment, count(*) AS customers, count(*) FILTER (WHERE churn_prediction = 1) AS customers_at_risk,
           {r("sum(CASE WHEN churn_prediction = 1 THEN total_revenue ELSE 0 END) / max(days)", 4)}
               AS daily_gmv_at_risk,
           {r("sum(total_revenue * churn_probability) / max(days)", 4)} AS daily_gmv_expected_loss
    FROM scored JOIN rfm_named USING (customer_unique_id)
    JOIN (SELECT customer_unique_id, total_revenue FROM customer_profile) USING (customer_unique_id), d
    GROUP BY segment""")
def _(t: Tables):
    # customers, segments and days all come from the fact, so it is written; label and revenue come from one aggregation
    fact = stored(t.fact, "fact")
    profile = churn.customer_profile(churn.churn_base(fact, t.stored_customers, t.stored_products, t.dim_payments))
    risk = extensions.revenue_at_risk(with_fixed_score(profile), assign_segments(_fixed(t, fact)), extensions.observed_days(fact))
    return rounded(risk, 4)


@query("forward_churn_label", f"""
    SELECT customer_unique_id, count(*) FILTER (WHERE order_purchase_timestamp < cut) AS orders_before,
           CAST(coalesce(sum(order_revenue) FILTER (WHERE order_purchase_timestamp < cut), 0) AS DOUBLE)
               AS revenue_before,
           max(order_purchase_timestamp) FILTER (WHERE order_purchase_timestamp < cut) AS last_before,
           CAST(count(*) FILTER (WHERE order_purchase_timestamp >= cut
                                 AND order_purchase_timestamp < cut + INTERVAL 90 DAY) = 0 AS INTEGER) AS churned_next
    FROM churn_base, (SELECT TIMESTAMP '{FORWARD_CUT} 00:00:00' AS cut)
    WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id, cut
    HAVING count(*) FILTER (WHERE order_purchase_timestamp < cut) > 0""")
def _(t: Tables):
    return extensions.forward_churn_label(base(t), FORWARD_CUT)
