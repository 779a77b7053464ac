"""Models, scoring, evaluation and attribution.

Evaluation is checked on a fixed score; the model queries themselves have no SQL form.
"""

from pyspark.sql import functions as F

from ..operators import attribution, boosting, evaluate, models
from ..operators.boosting import BoostedTrees
from ..operators.churn import FEATURES, customer_profile, split_rows
from ..session import scratch_path
from ..sources import read_csv, write_csv
from .catalog_churn import base, scored, split
from .oracle_tables import r
from .registry import query, rounded
from .tables import Tables

def _features(t: Tables):
    """Features of all customers, from a table that is written once."""
    return t.once("features", lambda: split(t))


def _gbt(t: Tables) -> BoostedTrees:
    """The boosted model, which is fitted once per folder and read by all queries that need it."""
    return t.model("gbt", BoostedTrees, lambda: models.fit_gbt(split_rows(_features(t))[0]))


def _fitted(t: Tables):
    """Both models by name, each with the test part as it reads it."""
    train, test = split_rows(models.model_input(_features(t))[0])
    return {"logreg": (models.fit_logistic(train), test), "gbt": (_gbt(t), split_rows(_features(t))[1])}


@query("logreg")
def _(t: Tables):
    vectors, _ = models.model_input(_features(t))
    model = models.fit_logistic(split_rows(vectors)[0])
    return models.score(model, vectors).select(*models.EXPORT, "split")


@query("gbt")
def _(t: Tables):
    return models.score(_gbt(t), _features(t)).select(*models.EXPORT, "split")


@query("score")
def _(t: Tables):
    return models.score(_gbt(t), _features(t))


@query("model_auc")
def _(t: Tables):
    aucs = [evaluate.roc_auc(models.score(m, test)).select(F.lit(n).alias("model"), "auc")
            for n, (m, test) in _fitted(t).items()]
    return aucs[0].unionByName(aucs[1])


_RANKED = """
    SELECT score, pos, neg, coalesce(sum(neg) OVER w, 0) AS before_neg, coalesce(sum(pos) OVER w, 0) AS before_pos,
           sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
    FROM (SELECT churn_probability AS score, count(*) FILTER (WHERE churned = 1) AS pos,
                 count(*) FILTER (WHERE churned = 0) AS neg FROM scored GROUP BY churn_probability)
    WINDOW w AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@query("roc_auc", f"SELECT {r('sum(pos * (before_neg + neg / 2.0)) / (max(all_pos) * max(all_neg))', 6)} AS auc "
       f"FROM ({_RANKED})")
def _(t: Tables):
    return rounded(evaluate.roc_auc(scored(t)))


@query("roc_curve", f"""
    SELECT CAST(score AS DOUBLE) AS threshold, {r("(all_neg - before_neg) / all_neg", 6)} AS fpr,
           {r("(all_pos - before_pos) / all_pos", 6)} AS tpr FROM ({_RANKED})
    UNION ALL SELECT NULL, 0.0, 0.0""")
def _(t: Tables):
    return rounded(evaluate.roc_curve(scored(t)), 6, "fpr", "tpr")


@query("confusion_matrix", """
    SELECT churned AS label, churn_prediction AS prediction, count(*) AS rows FROM scored GROUP BY ALL""")
def _(t: Tables):
    return evaluate.confusion_matrix(scored(t))


@query("classification_report", f"""
    WITH c AS (
        SELECT k, count(*) FILTER (WHERE churned = k AND churn_prediction = k) AS hit,
               count(*) FILTER (WHERE churn_prediction = k) AS said, count(*) FILTER (WHERE churned = k) AS support,
               count(*) AS n
        FROM scored, (SELECT unnest([0, 1]) AS k) GROUP BY k),
    m AS (SELECT *, coalesce(hit / nullif(said, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS q FROM c),
    f AS (SELECT *, coalesce(2 * p * q / nullif(p + q, 0), 0) AS f1 FROM m)
    SELECT CAST(k AS VARCHAR) AS "class", {r("p", 6)} AS precision, {r("q", 6)} AS recall, {r("f1", 6)} AS f1, support FROM f
    UNION ALL SELECT 'accuracy', {r("sum(hit) / max(n)", 6)}, {r("sum(hit) / max(n)", 6)}, {r("sum(hit) / max(n)", 6)},
                     max(n) FROM f
    UNION ALL SELECT 'macro avg', {r("avg(p)", 6)}, {r("avg(q)", 6)}, {r("avg(f1)", 6)}, max(n) FROM f
    UNION ALL SELECT 'weighted avg', {r("sum(p * support) / max(n)", 6)}, {r("sum(q * support) / max(n)", 6)},
                     {r("sum(f1 * support) / max(n)", 6)}, max(n) FROM f""")
def _(t: Tables):
    return rounded(evaluate.classification_report(scored(t)))


@query("top_risk", """
    SELECT customer_unique_id, churned, CAST(churn_probability AS DOUBLE) AS churn_probability, churn_prediction
    FROM scored ORDER BY churn_probability DESC, customer_unique_id LIMIT 20""")
def _(t: Tables):
    return models.top_risk(scored(t))


@query("attribution")
def _(t: Tables):
    _, test = split_rows(_features(t))
    return attribution.mean_attribution(attribution.attributions(_gbt(t), test), FEATURES)


@query("attribution_rows")
def _(t: Tables):
    """Contributions next to the margin they add up to."""
    _, test = split_rows(_features(t))
    model = _gbt(t)
    parts = attribution.attributions(model, test)
    total = sum((F.col(c) for c in model.columns), F.col("base"))
    return parts.withColumn("total", total).join(models.margin(model, test), "customer_unique_id")


@query("churn_export")
def _(t: Tables):
    return models.churn_export(models.score(_gbt(t), _features(t)))


@query("churn_export_fixed", """
    SELECT customer_unique_id, total_orders, total_revenue, {aov} AS avg_order_value,
           CAST(churn_probability AS DOUBLE) AS churn_probability, churn_prediction, scored.churned AS churned
    FROM scored JOIN (SELECT customer_unique_id, total_orders, total_revenue, avg_order_value FROM customer_profile)
    USING (customer_unique_id)""".format(aov=r("avg_order_value", 6)))
def _(t: Tables):
    """The export over the fixed score, written and read back."""
    profile = customer_profile(base(t)).select("customer_unique_id", "total_orders", "total_revenue", "avg_order_value")
    export = models.churn_export(scored(t).join(profile, "customer_unique_id"))
    path = scratch_path(t.spark, "churn-csv")
    write_csv(export, path)
    return rounded(read_csv(t.spark, path, export.schema), 6, "avg_order_value")


_COEFFICIENTS = {"total_orders": -0.5, "avg_review_score": 0.25, "purchase_month": 0.125}


@query("logistic_score", f"""
    SELECT customer_unique_id, {r("1 / (1 + exp(-z))", 6)} AS churn_probability,
           CAST(1 / (1 + exp(-z)) > 0.5 AS INTEGER) AS churn_prediction
    FROM (SELECT customer_unique_id, {" + ".join(f"{v} * {c}" for c, v in _COEFFICIENTS.items())} - 0.75 AS z FROM features)""")
def _(t: Tables):
    """Probabilities of stated coefficients, as a fitted logistic model gives them."""
    found = models.logistic_score(_features(t), _COEFFICIENTS, -0.75)
    return rounded(found.select("customer_unique_id", "churn_probability", "churn_prediction"), 6, "churn_probability")


@query("model_roc_curve")
def _(t: Tables):
    """ROC points of both fitted models on the test part."""
    curves = [evaluate.roc_curve(models.score(m, test)).withColumn("model", F.lit(n)) for n, (m, test) in _fitted(t).items()]
    return curves[0].unionByName(curves[1])


@query("model_report")
def _(t: Tables):
    """Classification report of the boosted model on the test part."""
    return evaluate.classification_report(models.score(_gbt(t), split_rows(_features(t))[1]))


# Stated bins, node, weight and score, so that SQL can follow one level of a tree: gaps in the mean review score, two nodes.
_CUTS = {"total_orders": [15.0, 18.0, 21.0], "avg_review_score": [2.8, 3.0, 3.2], "purchase_month": [6.0, 6.5, 7.0]}
_POSITIVE = 1.5


def _level(t: Tables):
    known = F.when(F.col("customer_unique_id") % 5 != 0, F.col("avg_review_score"))
    rows = _features(t).withColumns({
        "avg_review_score": known, "node": (1 + F.col("customer_unique_id") % 2).cast("int"),
        "p": (F.col("customer_unique_id") * 7919 % 1000).cast("double") / 1000})
    cut = boosting.binned(rows, list(_CUTS), list(_CUTS.values()))
    weight = F.when(F.col("churned") == 1, F.lit(_POSITIVE)).otherwise(F.lit(1.0))
    return boosting.histograms(boosting.with_gradients(cut, F.col("p"), "churned", weight))


_BINS = ", ".join(f"""CASE WHEN {c} IS NULL THEN {boosting.MISSING} ELSE {" + ".join(
    f"CAST({c} >= {x} AS INTEGER)" for x in cuts)} END""" for c, cuts in _CUTS.items())
_HISTOGRAM = f"""
    given AS (SELECT customer_unique_id % 2 + 1 AS node, churned, (customer_unique_id * 7919 % 1000) / 1000.0 AS p,
                     CASE WHEN churned = 1 THEN {_POSITIVE} ELSE 1.0 END AS w, total_orders, purchase_month,
                     CASE WHEN customer_unique_id % 5 <> 0 THEN avg_review_score END AS avg_review_score FROM features),
    cut AS (SELECT node, CAST(round((p - churned) * w * {boosting.ONE}) AS BIGINT) AS g,
                   CAST(round(p * (1 - p) * w * {boosting.ONE}) AS BIGINT) AS h, unnest([0, 1, 2]) AS feature, unnest([{_BINS}]) AS bin
            FROM given),
    sums AS (SELECT CAST(node AS INTEGER) AS node, feature, bin, CAST(sum(g) AS BIGINT) AS g, CAST(sum(h) AS BIGINT) AS h
             FROM cut GROUP BY ALL)"""


@query("gbt_histograms", f"WITH {_HISTOGRAM} SELECT * FROM sums")
def _(t: Tables):
    """Gradients and hessians by node, feature and bin of one level of a tree."""
    return _level(t)


@query("gbt_splits", f"""
    WITH {_HISTOGRAM},
    total AS (SELECT node, sum(g) AS g, sum(h) AS h FROM sums WHERE feature = 0 GROUP BY node),
    place AS (SELECT DISTINCT node, feature, unnest([1, 2, 3]) AS bin FROM sums),
    side AS (SELECT *, unnest([true, false]) AS missing_left FROM place),
    lefts AS (SELECT side.node, side.feature, side.bin, missing_left, coalesce(sum(sums.g), 0) AS lg, coalesce(sum(sums.h), 0) AS lh
              FROM side LEFT JOIN sums ON side.node = sums.node AND side.feature = sums.feature
                   AND (sums.bin BETWEEN 0 AND side.bin - 1 OR sums.bin = {boosting.MISSING} AND missing_left) GROUP BY ALL),
    gains AS (SELECT *, pow(lg / {boosting.ONE}.0, 2) / (lh / {boosting.ONE}.0 + 1) + pow((g - lg) / {boosting.ONE}.0, 2) / ((h - lh) / {boosting.ONE}.0 + 1)
                        - pow(g / {boosting.ONE}.0, 2) / (h / {boosting.ONE}.0 + 1) AS gain
              FROM lefts JOIN total USING (node) WHERE lh >= {boosting.ONE} AND h - lh >= {boosting.ONE})
    SELECT node, feature, CAST(bin AS INTEGER) AS bin, CAST(missing_left AS INTEGER) AS missing_left, {r("gain", 6)} AS gain
    FROM gains QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, feature, bin, missing_left DESC) = 1""")
def _(t: Tables):
    """The best split of every node of that level."""
    sums = _level(t).toPandas()  # nodes x features x bins
    cuts = list(_CUTS.values())
    found = boosting.best_splits(*boosting.dense(sums, cuts), cuts)
    rows = [(n, s["feature"], s["bin"], int(s["missing_left"]), s["gain"]) for n, s in found.items() if "feature" in s]
    return rounded(t.spark.createDataFrame(rows, "node int, feature int, bin int, missing_left int, gain double"))
