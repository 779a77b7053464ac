"""Distinct active customers from one table of bitmaps, each against a count of distinct customers."""

from ..operators import actives
from ..session import stored
from .oracle_tables import r
from .registry import query
from .tables import Tables

_MONTHS = """
    WITH m AS (SELECT DISTINCT customer_unique_id, date_trunc('month', order_purchase_timestamp) AS month
               FROM fact_orders JOIN dim_customers USING (customer_id)
               WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL)"""


def _rows(t: Tables):
    numbers = actives.customer_numbers(t.dim_customers)
    return stored(actives.numbered_months(t.fact, t.dim_customers, numbers), "numbered-months")


@query("active_customers", f"""{_MONTHS}
    SELECT strftime(month, '%Y-%m') AS order_month, count(*) AS active_customers FROM m GROUP BY month""")
def _(t: Tables):
    return actives.monthly_actives(actives.bitmaps(_rows(t), "month"))


@query("active_customers_rolling", f"""{_MONTHS}
    SELECT strftime(w.month, '%Y-%m') AS order_month, count(DISTINCT customer_unique_id) AS active_customers
    FROM (SELECT DISTINCT month FROM m) w JOIN m ON m.month BETWEEN w.month - INTERVAL 2 MONTH AND w.month GROUP BY w.month""")
def _(t: Tables):
    return actives.rolling_actives(stored(actives.bitmaps(_rows(t), "month"), "active"))


@query("active_customers_retention", f"""{_MONTHS},
         c AS (SELECT customer_unique_id, min(month) AS cohort FROM m GROUP BY customer_unique_id),
         n AS (SELECT cohort, CAST((year(month) - year(cohort)) * 12 + month(month) - month(cohort) AS INTEGER) AS age_months,
                      count(*) AS active_customers FROM m JOIN c USING (customer_unique_id) GROUP BY ALL),
         s AS (SELECT cohort, count(*) AS cohort_size FROM c GROUP BY cohort)
    SELECT strftime(cohort, '%Y-%m') AS cohort_month, age_months, active_customers, cohort_size,
           {r("active_customers * 100.0 / cohort_size")} AS retention_pct FROM n JOIN s USING (cohort)""")
def _(t: Tables):
    rows = _rows(t)
    return actives.retention(stored(actives.bitmaps(rows, "month"), "active"), rows)
