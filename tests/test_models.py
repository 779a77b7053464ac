"""Models by what must hold whatever they learn."""

import itertools
import math
import os
import subprocess
import sys

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordertrail.operators import attribution, boosting, churn, evaluate, kmeans, models, segments
from ordertrail.operators.rfm import zscore
from ordertrail.session import drop_scratch, stored

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def planted(spark):
    """The label follows ``a`` with some noise and ignores ``c``."""
    df = spark.range(600).selectExpr(
        "id AS customer_unique_id", "CAST(id * 37 % 101 AS DOUBLE) AS a", "CAST(id * 53 % 17 AS DOUBLE) AS b",
        "CAST(id * 71 % 23 AS DOUBLE) AS c", "CASE WHEN id % 3 = 0 THEN 'test' ELSE 'train' END AS split",
        "CAST(id * 37 % 101 + 2 * (id * 53 % 17) > CASE WHEN id % 10 = 0 THEN 10 ELSE 70 END AS INT) AS churned")
    return stored(df)


@pytest.fixture(scope="module")
def gbt(planted):
    train, test = churn.split_rows(planted)
    return models.fit_gbt(train, COLUMNS, max_iter=5, max_depth=3), test


def test_models_find_the_signal(planted, gbt):
    model, test = gbt
    train, vectors = churn.split_rows(models.model_input(planted, COLUMNS)[0])
    for fitted, part in ((model, test), (models.fit_logistic(train), vectors)):
        scored = models.score(fitted, part)
        assert evaluate.roc_auc(scored).first()["auc"] > 0.8
        assert scored.filter("churn_prediction <> CAST(churn_probability > 0.5 AS INT)").count() == 0


def test_logistic_solves_the_stated_problem(spark, planted):
    """At the solution the gradient of the summed log loss plus half the squared weights is zero."""
    vectors, _ = models.model_input(planted, COLUMNS)
    model = models.fit_logistic(vectors)
    pdf = planted.toPandas()
    x, y = pdf[COLUMNS].to_numpy(float), pdf.churned.to_numpy()
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    gradient = x.T @ (p - y) + w
    assert np.abs(gradient).max() / np.abs(x.T @ y).max() < 1e-3


def test_gaps_get_a_column(spark, planted):
    gappy = planted.withColumn("b", F.expr("CASE WHEN b < 15 THEN b END"))
    vectors, names = models.model_input(gappy, COLUMNS)
    assert names == [*COLUMNS, "b_missing"]
    assert vectors.filter("b IS NULL").count() == 0


def test_attributions_add_up_to_the_margin(planted, gbt):
    model, test = gbt
    parts = attribution.attributions(model, test)
    joined = parts.join(models.margin(model, test), "customer_unique_id").toPandas()
    assert np.abs(joined[COLUMNS].sum(axis=1) + joined.base - joined.margin).max() < 1e-9
    means = dict(rows(attribution.mean_attribution(parts, COLUMNS)))
    assert means["a"] == max(means.values())
    assert means["a"] == pytest.approx(joined.a.abs().mean())


def expected(tree, x, known, at=0):
    """The margin of a tree with some features known and the others averaged over."""
    f = tree.feature[at]
    if f < 0:
        return tree.value[at]
    left, right = 2 * at + 1, 2 * at + 2
    if f in known:
        to_left = tree.missing_left[at] if np.isnan(x[f]) else x[f] < tree.cut[at]
        return expected(tree, x, known, left if to_left else right)
    return sum(tree.cover[i] * expected(tree, x, known, i) for i in (left, right)) / tree.cover[at]


def shapley(trees, x):
    """From the definition: all sets of known features."""
    m, out = len(x), []
    value = {s: sum(expected(t, x, s) for t in trees)
             for k in range(m + 1) for s in map(frozenset, itertools.combinations(range(m), k))}
    for i in range(m):
        out.append(sum(math.factorial(len(s)) * math.factorial(m - len(s) - 1) / math.factorial(m) * (value[s | {i}] - value[s])
                       for s in value if i not in s))
    return out


def random_tree(rng, depth, features):
    """Every node's cover is what its children have."""
    tree = boosting.Tree.empty(depth)
    inner = 2 ** depth - 1
    tree.feature[:inner] = rng.integers(0, features, inner)
    tree.cut[:inner], tree.missing_left[:inner] = rng.normal(size=inner), rng.random(inner) < .5
    tree.value[:] = rng.normal(size=len(tree.value))
    tree.cover[inner:] = rng.random(inner + 1) + .1
    for n in reversed(range(inner)):
        tree.cover[n] = tree.cover[2 * n + 1] + tree.cover[2 * n + 2]
    return tree


@pytest.mark.parametrize("depth, features", [(1, 3), (3, 2), (5, 6), (5, 8)])
def test_attributions_are_shapley_values(depth, features):
    rng = np.random.default_rng(depth * features)
    trees = [random_tree(rng, depth, features) for _ in range(2)]
    x = rng.normal(size=(6, features))
    x[rng.random(x.shape) < .2] = np.nan
    found = attribution._attribute([attribution.leaves(t) for t in trees], x)
    assert np.allclose(found, [shapley(trees, row) for row in x], atol=1e-10)


@pytest.mark.parametrize("depth, features", [(2, 3), (5, 6)])
def test_polynomials_are_worked_out_once_per_pattern(depth, features, monkeypatch):
    rng = np.random.default_rng(depth)
    tables = [attribution.leaves(random_tree(rng, depth, features)) for _ in range(2)]
    x = rng.normal(size=(300, features))
    x[rng.random(x.shape) < .2] = np.nan
    one_by_one = np.concatenate([attribution._attribute(tables, row[None]) for row in x])
    made, plain = [], attribution.contributions
    monkeypatch.setattr(attribution, "contributions", lambda of, tests: made.append(len(tests)) or plain(of, tests))
    assert np.allclose(attribution._attribute(tables, x), one_by_one, atol=1e-12)
    assert made == [2 ** of.feature.shape[1] for of in tables]
    monkeypatch.setattr(attribution, "HELD", 100)
    assert np.allclose(attribution._attribute(tables, x), one_by_one, atol=1e-12)


def test_attributions_use_all_cores(spark, gbt):
    model, test = gbt
    assert attribution.attributions(model, test.coalesce(1)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_attributions_of_deep_trees_add_up(spark):
    """Paths of a dozen features, which no table of all sets could hold for every leaf."""
    rng = np.random.default_rng(1)
    model = boosting.BoostedTrees([f"f{i}" for i in range(40)], [random_tree(rng, 12, 40)])
    x = rng.normal(size=(30, 40))
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], ["customer_unique_id", *model.columns])
    found = attribution.attributions(model, df).join(models.margin(model, df), "customer_unique_id").toPandas()
    assert np.abs(found[model.columns].sum(axis=1) + found.base - found.margin).max() < 1e-9
    assert found.margin.std() > 0


@pytest.fixture(scope="module")
def customers(spark):
    df = spark.range(400).selectExpr(
        "id AS customer_unique_id", "CAST(id % 4 * 100 + id % 7 AS INT) AS recency",
        "id % 4 + 1 AS frequency", "CAST(id % 4 * 1000 + id % 13 AS DOUBLE) AS monetary")
    return stored(zscore(df))


Z = ["recency_z", "frequency_z", "monetary_z"]


def test_kmeans(customers):
    fit = segments.kmeans_fit(customers, Z, 4, n_init=3)
    assigned = segments.kmeans_assign(customers, Z, 4, n_init=3)
    pdf = assigned.toPandas()
    x = pdf[Z].to_numpy()
    distance = ((x[:, None, :] - fit.centers[None]) ** 2).sum(axis=2)
    assert (distance.argmin(axis=1) == pdf.cluster).all()
    assert fit.cost == pytest.approx(distance.min(axis=1).sum())
    assert segments.inertia(assigned, Z).first()[0] == pytest.approx(fit.cost)
    named = segments.assign_segments(assigned)
    assert dict(rows(segments.segment_counts(named))) == dict.fromkeys(segments.SEGMENT_NAMES, 100)


def lloyd(x, centers, max_iter=300, tol=1e-4):
    for _ in range(max_iter):
        nearest = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[nearest == c].mean(axis=0) if (nearest == c).any() else centers[c] for c in range(len(centers))])
        moved = np.sqrt(((new - centers) ** 2).sum(axis=1)).max()
        centers = new
        if moved <= tol:
            break
    return centers, ((x[:, None, :] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_all_starts_together_are_each_start_alone(customers):
    x = customers.select(*Z).toPandas().to_numpy()
    starts = kmeans.starts_of(customers, Z, [2, 3, 5], 3, 7)
    assert [len(s.centers) for s in starts] == [2] * 3 + [3] * 3 + [5] * 3
    # drawn from the rows, whatever their partitions
    assert all((s.centers[:, None] == x[None]).all(axis=2).any(axis=1).all() for s in starts)
    again = kmeans.starts_of(customers.orderBy("monetary").repartition(5), Z, [2, 3, 5], 3, 7)
    assert all((a.centers == b.centers).all() for a, b in zip(starts, again))
    wanted = [lloyd(x, s.centers) for s in starts]
    kmeans.settle(customers, Z, starts)
    for start, (centers, cost) in zip(starts, wanted):
        assert start.settled and np.allclose(start.centers, centers) and start.cost == pytest.approx(cost)
    assert kmeans.best_of(starts, 5).cost == min(s.cost for s in starts if s.k == 5)


def test_one_scan_moves_all_starts(customers, monkeypatch):
    starts, calls = kmeans.starts_of(customers, Z, [2, 3], 4, 1), []
    real = kmeans._per_task
    monkeypatch.setattr(kmeans, "_per_task", lambda *args: calls.append(real(*args)) or calls[-1])
    kmeans.move(kmeans.numbers(customers, Z), 3, starts)
    assert len(calls) == 1
    assert calls[0]._jdf.queryExecution().executedPlan().toString().count("Scan") <= 2  # the node and its description


def test_fewer_rows_than_clusters(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "a double")
    fit = segments.kmeans_fit(df, ["a"], 5, n_init=2)
    assert sorted(fit.centers.ravel().tolist()) == [1.0, 2.0] and fit.cost == 0
    assert segments.kmeans_assign(df, ["a"], 5, n_init=2).select("cluster").distinct().count() == 2
    with pytest.raises(Exception, match="missing value"):
        segments.kmeans_fit(df.unionByName(spark.createDataFrame([(None,)], df.schema)), ["a"], 2)


def test_draws_follow_the_squared_distance(spark):
    """Of rows at 1 and 3 from the only center, the far one is drawn nine times in ten."""
    df = spark.createDataFrame([(0.0,), (1.0,), (3.0,)], "a double")
    starts = [kmeans.Start(2, seed, np.array([[0.0]])) for seed in range(400)]
    kmeans._draw(kmeans.numbers(df, ["a"]), 1, starts, 1)
    far = sum(s.centers[1, 0] == 3.0 for s in starts) / len(starts)
    assert 0.84 < far < 0.96


def test_sweep(customers):
    sweep = segments.k_sweep(customers, Z, range(2, 6), n_init=2)
    found = {r["k"]: r for r in sweep.collect()}
    assert segments.choose_k() == 4 and segments.choose_k(sweep) == max(found, key=lambda k: found[k]["silhouette"])
    assert found[4]["inertia"] < found[2]["inertia"]


def test_silhouette_against_pairs_and_the_library(customers):
    from pyspark.ml.evaluation import ClusteringEvaluator
    df = customers.withColumn("cluster", F.expr("CASE WHEN customer_unique_id = 0 THEN 9 ELSE customer_unique_id % 3 END"))
    pdf = segments.silhouette_rows(df, Z).toPandas()
    x, c = pdf[Z].to_numpy(), pdf.cluster.to_numpy()
    d = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    for i in range(len(x)):
        own = (c == c[i]).sum()
        if own == 1:
            assert pdf.silhouette[i] == 0
            continue
        a = d[i][c == c[i]].sum() / (own - 1)
        b = min(d[i][c == k].mean() for k in set(c) - {c[i]})
        assert pdf.silhouette[i] == pytest.approx((b - a) / max(a, b), abs=1e-9)
    judged = ClusteringEvaluator(predictionCol="cluster").evaluate(
        segments.as_vectors(df, Z).withColumn("cluster", F.col("cluster").cast("int")))
    assert segments.silhouette(df, Z).first()[0] == pytest.approx(judged)


def test_constant_column_standardises_to_zero(spark):
    df = spark.range(5).selectExpr("id", "3.0D AS v")
    assert rows(zscore(df, ["v"]), "v_z") == [(0.0,)] * 5


def test_scratch_is_dropped_last(spark):
    stored(spark.range(3))
    assert drop_scratch(spark) > 0 and drop_scratch(spark) == 0


def test_attribution_where_workers_lack_the_package(tmp_path):
    """From another folder, with the package on the driver's path only."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import functions as F
from ordertrail.operators import attribution, models
from ordertrail.session import get_session
spark = get_session("local[2]", spark__checkpoint__dir={str(tmp_path / 'shared')!r}, spark__sql__shuffle__partitions="2")
df = spark.range(200).selectExpr("id AS customer_unique_id", "CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b",
                                 "CAST(id % 7 > 3 AS INT) AS churned")
model = models.fit_gbt(df, ["a", "b"], max_iter=2, max_depth=2)
parts = attribution.attributions(model, df).join(models.margin(model, df), "customer_unique_id")
assert parts.where("abs(base + a + b - margin) > 1e-9").count() == 0 and parts.count() == 200
print("attributed")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "elsewhere").mkdir()
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "elsewhere", env=env, capture_output=True, text=True,
                          timeout=300)
    assert "attributed" in done.stdout, done.stderr[-3000:]


def test_the_rows_of_a_sweep_are_on_all_cores(spark, monkeypatch):
    """A table in one small file is not worked on by one task."""
    seen, settle = [], kmeans.settle
    monkeypatch.setattr(kmeans, "settle", lambda rows, *rest: seen.append(rows.rdd.getNumPartitions()) or settle(rows, *rest))
    df = spark.range(60).selectExpr("CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 11 AS DOUBLE) AS b")
    sweep = segments.k_sweep(df.coalesce(1), ["a", "b"], range(2, 4), n_init=1, max_iter=3)
    assert [r["k"] for r in sweep.orderBy("k").collect()] == [2, 3]
    assert seen and min(seen) >= spark.sparkContext.defaultParallelism
