"""Recall against brute force, exact scores, and odd vectors."""

import numpy as np
import pytest

from ordertrail.llm import ann
from ordertrail.llm.queries import op6_nearest_neighbours


def brute(ids, vectors, query, own, k=10):
    distances = np.sqrt(((vectors - query) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, distances)) if ids[i] != own][:k]
    return [(int(ids[i]), float(distances[i])) for i in order]


def recall(found, ids, vectors, queries):
    hit = total = 0
    for q in queries:
        expected = brute(ids, vectors, vectors[ids == q][0], q)
        rows = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        assert [(r["score"], r["vec_id"]) for r in rows] == sorted((r["score"], r["vec_id"]) for r in rows)
        for r in rows:
            exact = np.sqrt(((vectors[ids == r["vec_id"]][0] - vectors[ids == q][0]) ** 2).sum())
            assert r["score"] == exact and r["vec_id"] != q
        hit += len({r["vec_id"] for r in rows} & {i for i, _ in expected})
        total += len(expected)
    return hit / total


def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    assert recall(op6_nearest_neighbours(spark, folder).collect(), ids, vectors, ids[ids % 100 == 0]) >= 0.9


def test_recall_over_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 200)
    monkeypatch.setattr(ann, "BLOCK", 150)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(40, 24))[rng.integers(0, 40, 4000)] + 0.3 * rng.normal(size=(4000, 24))
    vectors[1000:2300] = vectors[7]  # a third of all
    ids = np.arange(4000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    found = ann.search(df, df.where("vec_id % 50 = 0")).collect()
    assert recall(found, ids, vectors, ids[::50]) >= 0.9
    copies = [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 1500]
    assert copies == [7, *range(1000, 1009)]


def test_balance():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(20, 8))[rng.integers(0, 20, 1500)] + 0.1 * rng.normal(size=(1500, 8))
    graph = ann.neighbour_graph(vectors, 10)
    label = ann.balanced_parts(vectors, graph, 10)
    assert np.bincount(label, minlength=10).max() <= ann.SLACK * 150 + 1
    assert (label[graph] == label[:, None]).mean() > 0.6


def test_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 5), (0, [1.0, 0.0], 5), (1, [1.0, 0.5], 5), (2, [1.0, 0.5], 5), (3, None, 5), (4, [0.0, 0.0], 5),
            (5, [nan, 1.0], 5), (6, [inf, 1.0], 5), (7, [None, 1.0], 5), (8, [], 5), (9, [1.0, 2.0, 3.0], 5), (None, [1.0, 1.0], 5),
            (100, [0.0, 3.0], 5), (200, None, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    found = ann.search(df, df.where("vec_id % 100 = 0")).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found)
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 100), (100, 1, 1), (100, 2, 2), (100, 3, 0)]
    # an id on several vectors is as near as the nearest of them, also as a query
    several = spark.createDataFrame([(1, [5.0, 0.0]), (1, [0.0, 5.0]), (2, [5.0, 1.0]), (3, [0.0, 7.0]), (3, [9.0, 9.0]), (4, [3.0, 3.0])] + [(3, [0.0, 7.0])] * 40,
                                    "vec_id long, embedding array<double>")
    rows = ann.search(several, several.where("vec_id = 1")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(rows, key=lambda r: r["rank"])] == [
        (1, 1, 2, 1.0), (1, 2, 3, 2.0), (1, 3, 4, 13 ** .5)]
    assert ann.search(df.limit(0), df).count() == 0
    one = df.where("vec_id = 1")
    assert ann.search(one, one).count() == 0
    with pytest.raises(ValueError):
        ann.search(df, df, k=0)
