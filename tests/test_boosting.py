"""Boosted trees against trees grown from the raw values, node by node and cut by cut."""

import pickle

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ordertrail.operators import boosting
from ordertrail.session import scratch_path

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(7)
    n = 400
    df = pd.DataFrame({"a": rng.integers(0, 30, n).astype(float), "b": (rng.normal(size=n) * 2).round() / 2, "c": rng.integers(0, 3, n) * 1.0})
    df["y"] = (df.a + 5 * df.b + rng.normal(size=n) * 4 > 16).astype(int)
    df.loc[rng.random(n) < .3, "b"] = np.nan
    df.loc[df.b.isna() & (rng.random(n) < .8), "y"] = 1
    return df


@pytest.fixture(scope="module")
def table(spark, values):
    rows = [tuple(None if v != v else v for v in row) for row in values.itertuples(index=False)]
    return spark.createDataFrame([(i, *r[:3], int(r[3])) for i, r in enumerate(rows)],
                                 "id long, a double, b double, c double, y int").repartition(3)


def brute(x, y, rounds, depth, rate, weight, l2=1.0, least=1.0):
    """Margins, and the splits of the first tree, by trying every value as a cut and both sides for missing ones."""
    w = np.where(y == 1, weight, 1.0)
    margin, first = np.zeros(len(y)), {}

    def grow(rows, level, node, g, h, splits, out):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None)
        for f in range(x.shape[1]):
            own = x[rows, f]
            for cut in [*np.unique(x[~np.isnan(x[:, f]), f])[1:], np.inf]:
                for missing in (True, False):
                    left = np.where(np.isnan(own), missing, own < cut)
                    lg, lh = g[rows][left].sum(), h[rows][left].sum()
                    if lh < least or total_h - lh < least:
                        continue
                    gain = lg ** 2 / (lh + l2) + (total_g - lg) ** 2 / (total_h - lh + l2) - total_g ** 2 / (total_h + l2)
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (f, cut, missing, left))
        if level == depth or best[1] is None:
            out[rows] = -rate * total_g / (total_h + l2)
            return
        f, cut, missing, left = best[1]
        splits[node] = (f, cut, missing)
        grow(rows[left], level + 1, 2 * node + 1, g, h, splits, out)
        grow(rows[~left], level + 1, 2 * node + 2, g, h, splits, out)

    for number in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        splits, out = {}, np.zeros(len(y))
        grow(np.arange(len(y)), 0, 0, (p - y) * w, p * (1 - p) * w, splits, out)
        margin += out
        if number == 0:
            first = splits
    return margin, first


def test_trees_equal_those_from_raw_values(table, values):
    model = boosting.fit(table, COLUMNS, "y", rounds=4, depth=3, rate=.3, positive_weight=1.7)
    margin, first = brute(values[COLUMNS].to_numpy(), values.y.to_numpy(), 4, 3, .3, 1.7)
    tree = model.trees[0]
    found = {n: (int(tree.feature[n]), float(tree.cut[n]), bool(tree.missing_left[n])) for n in range(7) if tree.feature[n] >= 0}
    assert {n: s[:2] for n, s in found.items()} == {n: s[:2] for n, s in first.items()}
    assert any(s[0] == 1 for s in found.values())
    scored = boosting.margin(model, table).orderBy("id").toPandas()
    assert np.abs(scored.margin.to_numpy() - margin).max() < 1e-6


def test_same_trees_whatever_the_partitions_and_the_order(spark, table, monkeypatch):
    one = boosting.fit(table.coalesce(1), COLUMNS, "y", rounds=3, depth=2)
    monkeypatch.setattr(boosting, "TASK_ROWS", 50)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 17)
    monkeypatch.setattr(boosting, "KEPT_EVERY", 1)
    other = boosting.fit(table.orderBy(F.desc("b")).repartition(6), COLUMNS, "y", rounds=3, depth=2)
    for a, b in zip(one.trees, other.trees):
        assert all((getattr(a, k) == getattr(b, k)).all() for k in ("feature", "bin", "cut", "missing_left", "value", "cover"))


def test_block_sums_are_the_histograms(table):
    """The sums of a fit's first level, as the DataFrame form has them."""
    cuts = boosting.cut_points(table, COLUMNS)
    rows = boosting.with_gradients(boosting.binned(table, COLUMNS, cuts), F.lit(0.5), "y", F.lit(1.0)).withColumn("node", F.lit(0))
    nodes, sums = boosting.dense(boosting.histograms(rows).toPandas(), cuts)
    tree = boosting.fit(table, COLUMNS, "y", rounds=1, depth=1).trees[0]
    split = boosting.best_splits(nodes, sums, cuts)[0]
    assert (tree.feature[0], tree.bin[0], tree.missing_left[0]) == (split["feature"], split["bin"], split["missing_left"])
    assert tree.cover[0] == split["h"] / boosting.ONE and tree.cover[1] == split["left_h"] / boosting.ONE


def test_missing_values_go_where_they_help(spark):
    df = spark.range(200).selectExpr("CASE WHEN id % 2 = 0 THEN CAST(id % 10 AS DOUBLE) END AS a", "CAST(id % 2 = 1 OR id % 10 > 6 AS INT) AS y")
    tree = boosting.fit(df, ["a"], "y", rounds=1, depth=1).trees[0]
    assert not tree.missing_left[0] and tree.cut[0] == 8.0
    turned = boosting.fit(df.withColumn("a", -F.col("a")), ["a"], "y", rounds=1, depth=1).trees[0]
    assert turned.missing_left[0]


def test_saved_and_read_again(spark, table):
    model = boosting.fit(table, COLUMNS, "y", rounds=2, depth=3)
    path = scratch_path(spark, "trees")
    model.save(spark, path)
    again = boosting.BoostedTrees.load(spark, path)
    assert again.columns == COLUMNS and len(again.trees) == 2
    both = boosting.margin(again, boosting.margin(model, table, "one"), "two").where("one <> two")
    assert both.count() == 0


def test_odd_inputs(spark, table):
    constant = table.withColumns({"a": F.lit(1.0), "b": F.lit(None).cast("double"), "c": F.lit(float("nan"))})
    model = boosting.fit(constant, COLUMNS, "y", rounds=2, depth=2)
    assert all((t.feature == -1).all() for t in model.trees)
    empty = boosting.fit(table.where("false"), COLUMNS, "y", rounds=2)
    assert {r["margin"] for r in boosting.margin(empty, table).select("margin").collect()} == {0.0}
    assert boosting.fit(table, COLUMNS, "y", rounds=0).trees == []
    named = table.withColumnsRenamed({"a": "margin", "b": "node", "c": "g.h"})
    assert boosting.margin(boosting.fit(named, ["margin", "node", "g.h"], "y", rounds=1), named, "out").count() == 400


def test_only_splits_reach_the_driver(table, monkeypatch):
    """Sums stay where they are added up: what a level sends does not grow with bins or tasks."""
    from pyspark.core.rdd import RDD

    monkeypatch.setattr(boosting, "LEAST_ROWS", 50)
    collect, sent = RDD.collect, []

    def weighed(self):
        found = collect(self)
        sent.append(len(pickle.dumps(found)))
        return found

    monkeypatch.setattr(RDD, "collect", weighed)
    model = boosting.fit(table.coalesce(1), COLUMNS, "y", rounds=2, depth=4)
    assert len(model.trees) == 2 and (model.trees[0].feature >= 0).sum() > 4
    assert len(sent) >= 8 and max(sent) < 500 + 8 * 250  # at most 8 nodes in a level


def test_few_rows_use_all_cores(spark, table):
    assert [boosting._tasks(n, 12) for n in (0, 9_000, 25_000, 210_000, 1_260_000, 60_000_000)] == [1, 1, 1, 5, 12, 120]
    model = boosting.fit(table, COLUMNS, "y", rounds=1, depth=1)
    assert boosting.margin(model, table.coalesce(1)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
