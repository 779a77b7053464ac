"""Recency, frequency, monetary value, and segmentation.

Queries over a fixed assignment use the cluster ``customer_unique_id % 4``, so that they can be checked
without a model.
"""

from pyspark.sql import functions as F

from ..operators import rfm as rfm_ops
from ..operators import segments
from ..session import scratch_path, stored
from ..sources import read_csv, write_csv
from .oracle_tables import r, re_
from .registry import query, rounded
from .tables import Tables

RFM = rfm_ops.RFM
Z = [f"{c}_z" for c in RFM]


def _rfm(t: Tables):
    return rfm_ops.rfm(t.fact, t.dim_customers)


def _fixed(t: Tables, fact=None):
    """Customers with a fixed cluster, from the fact or a written copy of it."""
    return rfm_ops.rfm(fact or t.fact, t.dim_customers).withColumn("cluster", (F.col("customer_unique_id") % 4).cast("int"))


def _standard(t: Tables):
    """Standardised customers with the fixed cluster, written once: means and rows read them again."""
    return stored(rfm_ops.zscore(stored(_fixed(t), "rfm")), "standard")


def _standardised(t: Tables):
    """Standardised customers, written once: every fit reads them many times."""
    return stored(rfm_ops.zscore(stored(_rfm(t), "rfm")), "standard")


def _sweep(t: Tables):
    """The sweep over k, done once per folder: two queries show it."""
    return t.once("k-sweep", lambda: segments.k_sweep(_standardised(t), Z))


def _assigned(t: Tables):
    return t.once("k-means", lambda: segments.kmeans_assign(_standardised(t), Z, segments.choose_k()))


_Z_SQL = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}_z" for c in RFM)


@query("rfm_base", "SELECT * REPLACE (CAST(order_revenue AS DOUBLE) AS order_revenue) FROM rfm_orders")
def _(t: Tables):
    return rfm_ops.rfm_base(t.fact, t.stored_customers)


@query("rfm", "SELECT customer_unique_id, recency, frequency, monetary FROM rfm")
def _(t: Tables):
    return _rfm(t)


@query("rfm_describe", " UNION ALL ".join(f"""
    SELECT '{c}' AS metric, count({c}) AS count, {re_(f"avg({c})")} AS mean, {re_(f"stddev_samp({c})")} AS std,
           {re_(f"min({c})")} AS min, {re_(f"quantile_cont(CAST({c} AS DOUBLE), 0.25)")} AS p25,
           {re_(f"quantile_cont(CAST({c} AS DOUBLE), 0.5)")} AS p50,
           {re_(f"quantile_cont(CAST({c} AS DOUBLE), 0.75)")} AS p75, {re_(f"max({c})")} AS max FROM rfm""" for c in RFM))
def _(t: Tables):
    return rfm_ops.describe(stored(_rfm(t), "rfm"))


@query("zscore", f"""
    SELECT customer_unique_id, {", ".join(f"{r(z, 6)} AS {z}" for z in Z)} FROM (SELECT *, {_Z_SQL} FROM rfm)""")
def _(t: Tables):
    return rounded(rfm_ops.zscore(_rfm(t)).select("customer_unique_id", *Z))


@query("kmeans_assign")
def _(t: Tables):
    return _assigned(t)


@query("k_sweep")
def _(t: Tables):
    return _sweep(t)


@query("choose_k")
def _(t: Tables):
    sweep = _sweep(t)
    best = segments.choose_k(sweep)
    return sweep.withColumns({"best_by_silhouette": (F.col("k") == best).cast("int"),
                              "chosen": (F.col("k") == segments.choose_k()).cast("int")})


@query("inertia", f"""
    SELECT {r("sum(pow(recency_z - mr, 2) + pow(frequency_z - mf, 2) + pow(monetary_z - mm, 2))", 4)} AS inertia
    FROM (SELECT *, avg(recency_z) OVER c AS mr, avg(frequency_z) OVER c AS mf, avg(monetary_z) OVER c AS mm
          FROM (SELECT *, {_Z_SQL} FROM rfm_fixed) WINDOW c AS (PARTITION BY cluster))""")
def _(t: Tables):
    return rounded(segments.inertia(_standard(t), Z), 4)


# the check takes every pair of customers; the operator does not
_PAIRS = f"""
    WITH z AS (SELECT customer_unique_id AS id, cluster, {_Z_SQL} FROM rfm_fixed),
         d AS (SELECT a.id, a.cluster AS own, b.cluster AS other,
                      sum(pow(a.recency_z - b.recency_z, 2) + pow(a.frequency_z - b.frequency_z, 2)
                          + pow(a.monetary_z - b.monetary_z, 2)) AS total, count(*) AS n
               FROM z a, z b GROUP BY a.id, a.cluster, b.cluster),
         s AS (SELECT id, own, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS a,
                      min(CASE WHEN own <> other THEN total / n END) AS b FROM d GROUP BY id, own)"""


@query("silhouette", f"{_PAIRS} SELECT {r('avg(coalesce((b - a) / greatest(a, b), 0))', 6)} AS silhouette FROM s")
def _(t: Tables):
    return rounded(segments.silhouette(_standard(t), Z))


@query("silhouette_rows", f"""
    {_PAIRS} SELECT id AS customer_unique_id, own AS cluster, {r('coalesce((b - a) / greatest(a, b), 0)', 6)}
    AS silhouette FROM s""")
def _(t: Tables):
    rows = segments.silhouette_rows(_standard(t), Z)
    return rounded(rows.select("customer_unique_id", "cluster", "silhouette"))


_SUMMARY = f"""
    SELECT cluster, {re_("avg(recency)")} AS recency, {re_("avg(frequency)")} AS frequency,
           {re_("sum(monetary_dec) / count(*)")} AS monetary, count(*) AS count FROM rfm_fixed GROUP BY cluster"""


@query("cluster_summary", _SUMMARY)
def _(t: Tables):
    return segments.cluster_summary(_fixed(t))


@query("t5_sort_summary", f"SELECT * FROM ({_SUMMARY}) ORDER BY monetary DESC")
def _(t: Tables):
    return segments.cluster_summary(_fixed(t)).orderBy(F.desc("monetary"), "cluster")


@query("assign_segments", "SELECT customer_unique_id, recency, frequency, monetary, cluster, segment FROM rfm_named")
def _(t: Tables):
    return segments.segments_export(segments.assign_segments(_fixed(t)))


@query("segment_profile", f"""
    SELECT segment, {re_("avg(recency)", 1)} AS recency, {re_("avg(frequency)", 1)} AS frequency,
           {re_("sum(monetary_dec) / count(*)", 1)} AS monetary FROM rfm_named GROUP BY segment""")
def _(t: Tables):
    return segments.segment_profile(segments.assign_segments(_fixed(t)))


@query("segment_counts", "SELECT segment, count(*) AS count FROM rfm_named GROUP BY segment")
def _(t: Tables):
    return segments.segment_counts(segments.assign_segments(_fixed(t)))


@query("value_counts", "SELECT order_status, count(*) AS count FROM fact_orders GROUP BY order_status")
def _(t: Tables):
    return segments.value_counts(t.fact, "order_status")


@query("segments_export")
def _(t: Tables):
    return segments.segments_export(segments.assign_segments(_assigned(t)))


@query("segments_export_fixed", "SELECT customer_unique_id, recency, frequency, monetary, cluster, segment FROM rfm_named")
def _(t: Tables):
    """The export over the fixed cluster, written and read back."""
    path = scratch_path(t.spark, "segments-csv")
    named = segments.segments_export(segments.assign_segments(_fixed(t)))
    write_csv(named, path)
    return read_csv(t.spark, path, named.schema)


_CENTERS = [(-1.0, -0.5, 0.25), (0.0, 0.0, 0.0), (1.0, 1.5, 2.0), (0.5, -1.0, -1.0)]


@query("nearest_center", f"""
    WITH z AS (SELECT customer_unique_id, {_Z_SQL} FROM rfm),
         c AS (SELECT * FROM (VALUES {", ".join(f"({i}, {a}, {b}, {c})" for i, (a, b, c) in enumerate(_CENTERS))}) v(id, a, b, c))
    SELECT customer_unique_id, CAST(arg_min(id, pow(recency_z - a, 2) + pow(frequency_z - b, 2) + pow(monetary_z - c, 2))
           AS INTEGER) AS cluster
    FROM z, c GROUP BY customer_unique_id""")
def _(t: Tables):
    """Assignment to stated centers, as a fitted model does it."""
    return segments.nearest_center(rfm_ops.zscore(stored(_rfm(t), "rfm")), Z, _CENTERS).select("customer_unique_id", "cluster")
