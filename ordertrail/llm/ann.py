"""Nearest neighbours through learned partitions.

A sample's neighbour graph is cut into balanced parts, so that neighbours mostly share a part. A small classifier
learns which part a vector belongs to. It files every vector under its most probable part and sends every query to
its most probable parts, where all vectors are compared exactly. Parts are dealt out in blocks of bounded size, so a
part that holds a third of all vectors is still many small tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package, stored

#: Vectors that shape the parts, chosen by hash. Every vector is filed, whatever the sample.
SAMPLE = 8192
NEIGHBOURS = 10
#: Wanted vectors per part, the most parts that the sample can shape, and the slack of the balance.
PART, MOST_PARTS, SLACK = 1500, 128, 1.1
#: A query visits its most probable parts until they make up this probability, and at least so many of them.
MASS, LEAST_PROBES = 0.97, 3
#: Vectors, and queries, per block: what one task compares at a time.
BLOCK, QUERY_BLOCK = 4096, 2048
HIDDEN, EPOCHS, RATE, MINIBATCH = 64, 60, 0.01, 256


def usable(column: str) -> Column:
    """True for vectors without null or non-finite components that are not zero."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~bad & F.exists(column, lambda x: x != 0)


def neighbour_graph(vectors: np.ndarray, k: int) -> np.ndarray:
    """Row i: the k nearest other rows of i; equal vectors may come first in any order."""
    k = min(k, len(vectors) - 1)
    squares = (vectors ** 2).sum(axis=1)
    out = np.empty((len(vectors), k), np.int64)
    for first in range(0, len(vectors), 512):
        rows = slice(first, first + 512)
        distances = squares[rows, None] + squares - 2 * vectors[rows] @ vectors.T
        distances[np.arange(len(distances)), np.arange(first, first + len(distances))] = np.inf
        out[rows] = np.argpartition(distances, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """A part for every row, of nearly equal sizes, that cuts few edges of the graph.

    Parts start around far-apart rows and then take, in each round, every row into the part that most of its
    neighbours are in and that has room, the most certain rows first.
    """
    rng = np.random.default_rng(seed)
    n = len(vectors)
    room = int(np.ceil(SLACK * n / parts))
    seeds = [int(rng.integers(n))]
    nearest = ((vectors - vectors[seeds[0]]) ** 2).sum(axis=1)
    while len(seeds) < parts:
        total = nearest.sum()
        seeds.append(int(rng.choice(n, p=nearest / total)) if total > 0 else int(rng.integers(n)))
        nearest = np.minimum(nearest, ((vectors - vectors[seeds[-1]]) ** 2).sum(axis=1))
    centers = vectors[seeds]
    label = np.zeros(n, np.int64)
    both = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()]),
                           np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])], axis=1)
    for turn in range(rounds):
        distances = (vectors ** 2).sum(axis=1)[:, None] + (centers ** 2).sum(axis=1) - 2 * vectors @ centers.T
        liking = -distances / max(float(np.abs(distances).mean()), 1e-12)
        if turn:
            votes = np.zeros((n, parts))
            np.add.at(votes, (both[0], label[both[1]]), 1)
            liking = votes + 0.5 * liking
        label = _fill(liking, room)
        for part in range(parts):
            if (label == part).any():
                centers[part] = vectors[label == part].mean(axis=0)
    return label


def _fill(liking: np.ndarray, room: int) -> np.ndarray:
    """The part each row likes best among those with room, rows with most to lose first."""
    n, parts = liking.shape
    label = np.full(n, -1)
    left = np.full(parts, room)
    liking = liking.copy()
    todo = np.arange(n)
    while len(todo):
        wish = liking[todo].argmax(axis=1)
        certain = np.partition(liking[todo], -2, axis=1)[:, -2] if parts > 1 else np.zeros(len(todo))
        order = np.argsort(-(liking[todo, wish] - certain), kind="stable")
        todo, wish = todo[order], wish[order]
        refused = []
        for part in np.unique(wish):
            rows = todo[wish == part]
            label[rows[:left[part]]] = part
            refused.append(rows[left[part]:])
            left[part] -= min(left[part], len(rows))
            if left[part] == 0:
                liking[:, part] = -np.inf
        todo = np.sort(np.concatenate(refused))
    return label


@dataclass
class Classifier:
    """A network of one hidden layer; its size is fixed by the dimension and the number of parts."""

    mean: np.ndarray
    scale: float
    weights: list[np.ndarray]

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        hidden = self._hidden((vectors - self.mean) / self.scale)
        return _softmax(hidden @ self.weights[2] + self.weights[3])

    def _hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.weights[0] + self.weights[1], 0)


def _softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def fit_classifier(vectors: np.ndarray, targets: np.ndarray, seed: int = 5) -> Classifier:
    """Learn the distribution over parts that each row of ``targets`` states, by Adam on cross entropy."""
    rng = np.random.default_rng(seed)
    mean = vectors.mean(axis=0)
    scale = float(np.sqrt(((vectors - mean) ** 2).mean())) or 1.0
    x = (vectors - mean) / scale
    dim, parts = x.shape[1], targets.shape[1]
    weights = [rng.normal(0, np.sqrt(2 / dim), (dim, HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    model = Classifier(mean, scale, weights)
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), MINIBATCH):
            rows = order[at:at + MINIBATCH]
            hidden = model._hidden(x[rows])
            error = (_softmax(hidden @ weights[2] + weights[3]) - targets[rows]) / len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            slopes = [x[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(sample: np.ndarray, total: int) -> Classifier:
    """Cut the sample's neighbour graph into balanced parts and learn to tell them."""
    parts = int(np.clip(total // PART, 1, min(MOST_PARTS, max(1, len(sample) // 16))))
    graph = neighbour_graph(sample, NEIGHBOURS)
    label = balanced_parts(sample, graph, parts)
    targets = np.zeros((len(sample), parts))
    np.add.at(targets, (np.arange(len(sample)), label), 1)
    if graph.shape[1]:  # a row's neighbours say where else its own neighbours are
        np.add.at(targets, (np.repeat(np.arange(len(sample)), graph.shape[1]), label[graph.ravel()]), 1)
    return fit_classifier(sample, targets / targets.sum(axis=1, keepdims=True))


def probes(likely: np.ndarray, filed: np.ndarray, enough: int) -> list[np.ndarray]:
    """Parts for each query, most probable first: up to ``MASS``, ``LEAST_PROBES`` and ``enough`` vectors in them."""
    order = np.argsort(-likely, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(likely, order, axis=1), axis=1)
    there = np.cumsum(filed[order], axis=1)
    needed = np.maximum((before < MASS).sum(axis=1) + 1, LEAST_PROBES)
    needed = np.maximum(needed, (there < enough).sum(axis=1) + 1)
    return [row[:n] for row, n in zip(order, needed)]


def nearest(query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, own: int, k: int, repeated: bool = False,
            ) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact distances of the k nearest vectors but the query's own; ties to the smaller id."""
    distances = np.sqrt(((vectors - query) ** 2).sum(axis=1))
    distances = np.where(ids == own, np.inf, distances)
    if repeated:  # of an id with several vectors, the nearest
        order = np.lexsort((distances, ids))
        first = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
        ids, distances = ids[first], distances[first]
    if len(ids) > k:  # all that are as near as the k-th
        some = np.flatnonzero(distances <= np.partition(distances, k - 1)[k - 1])
    else:
        some = np.arange(len(ids))
    some = some[np.lexsort((ids[some], distances[some]))]
    some = some[ids[some] != own][:k]
    return ids[some], distances[some]


def search(df: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest vectors found for each query, nearest first.

    ``df`` are the candidates, ``queries`` rows of the same kind; a query does not find rows with its own key. The
    score is the Euclidean distance in double precision; ties go to the smaller key. Vectors that are null, zero or
    hold null or non-finite components, rows with a null key, and vectors of another dimension than most have take
    no part, as query or candidate. An id on several vectors is as near as the nearest of them, and as a query it is as
    near to others as any of them; repeated rows count once. A query gets fewer rows if there are fewer candidates,
    and none if there is none. Fitting sees at most about ``SAMPLE`` rows; every usable row is filed.
    """
    if k < 1:
        raise ValueError("k must be positive")
    spark = df.sparkSession

    def usable_rows(rows: DataFrame) -> DataFrame:
        return rows.where(F.col(key).isNotNull() & usable(vector)).select(
            F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))

    rows = usable_rows(df)
    by_size = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if by_size is None:
        return empty
    dim, total = by_size["dim"], by_size["n"]
    rows = rows.where(F.size("v") == dim)
    steps = 1 << 30
    share = min(1.0, SAMPLE / total)
    # by hash of the vector: copies of one vector are in the sample together or not at all, and count once there
    chosen = rows.where(F.pmod(F.xxhash64("v"), F.lit(steps)) < max(1, int(share * steps))).select("v").distinct().limit(2 * SAMPLE)
    sample = np.array([r["v"] for r in chosen.collect()], float).reshape(-1, dim)
    if len(sample) < 2:
        sample = np.array([r["v"] for r in rows.select("v").limit(2).collect()], float).reshape(-1, dim)
    order = np.lexsort(sample.T[::-1])  # the same fit however rows arrive
    ship_package(spark)
    model = spark.sparkContext.broadcast(fit(sample[order], total))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = model.value.probabilities(matrix(batch.column(1), dim)).argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(part.astype(np.int32))], names=["id", "v", "part"])

    filed = stored(rows.mapInArrow(file, "id bigint, v array<double>, part int"), "filed")
    sizes = {r["part"]: r["n"] for r in filed.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row a part
    counts = np.array([sizes.get(p, 0) for p in range(len(model.value.weights[3]))])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                chosen_parts = probes(model.value.probabilities(matrix(batch.column(1), dim)), counts, 4 * k)
                at = pa.array(np.repeat(np.arange(batch.num_rows), list(map(len, chosen_parts))))
                parts = pa.array(np.concatenate(chosen_parts).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), parts], names=["id", "v", "part"])

    asked = usable_rows(queries).where(F.size("v") == dim).dropDuplicates(["id", "v"])
    sent = stored(asked.mapInArrow(send, "id bigint, v array<double>, part int"), "sent")
    asks = {r["part"]: r["n"] for r in sent.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row a part

    def block_count(n: dict[int, int], size: int) -> Column:
        """Blocks of the row's part: a map with an entry per part."""
        entries = [F.lit(int(x)) for p in range(len(counts)) for x in (p, -(-n.get(p, 0) // size))]
        return F.element_at(F.create_map(*entries), F.col("part"))

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    # every block of vectors of a part meets every block of the queries that visit it
    in_part, visiting = block_count(sizes, BLOCK), block_count(asks, QUERY_BLOCK)
    left = sent.where(in_part > 0).withColumn("block", every(in_part)).withColumn(
        "ask", F.pmod(F.xxhash64("id", F.lit(1)), visiting).cast("int"))
    # dealt out by row, so that a repeated id fills no block
    right = filed.where(visiting > 0).withColumn(
        "block", F.pmod(F.monotonically_increasing_id(), in_part).cast("int")).withColumn("ask", every(visiting))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, vectors = right["id"].to_numpy(), np.stack(right["v"].to_numpy())
            repeated = len(np.unique(ids)) < len(ids)
            for own, query in zip(left["id"].to_numpy(), left["v"].to_numpy()):
                found, distances = nearest(query, ids, vectors, own, k, repeated)
                out.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": distances}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    keys = ("part", "block", "ask")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        compare, "query_id bigint, vec_id bigint, score double")
    # an id of several vectors may be found once for each, and asks with each
    once = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list column."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
