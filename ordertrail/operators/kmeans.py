"""K-Means from many starts, for several numbers of clusters, in the same passes over the rows.

Every pass moves the centers of all starts that have not settled: tasks add up their rows by start and nearest center, and
one aggregation adds up the tasks. What reaches the driver is a row per start and center. Starts are drawn by k-means++, a
pass per center for all starts, from a hash of the rows' values, so they do not depend on the rows' order or partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

#: Distances between rows and centers that are held at once.
HELD = 4_000_000


@dataclass
class Start:
    """One start: its number of clusters, its seed, and its centers so far; ``cost`` is the sum of squared distances."""

    k: int
    seed: int
    centers: np.ndarray
    cost: float = float("inf")
    settled: bool = False


def _columns(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n)])


def _blocks(x: np.ndarray, centers: int) -> Iterator[slice]:
    step = max(1, HELD // max(1, centers * x.shape[1]))
    return (slice(at, at + step) for at in range(0, len(x), step))


def _squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances (rows, centers), from differences: exact enough for rows that are centers."""
    return ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)


def _per_task(df: DataFrame, ddl: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[list[tuple]]]) -> DataFrame:
    """Rows that ``work`` makes of a task's batches."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_parse_datatype_string(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in work(batches):
            arrays = [pa.array(column, f.type) for column, f in zip(zip(*rows), schema)] if rows else [
                pa.array([], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(run, ddl)


def _uniform(hashes: np.ndarray, seed: int, k: int, round_: int) -> np.ndarray:
    """Numbers over 0 and up to 1 that follow from a row's hash and the draw."""
    salt = (seed * 1_000_003 + k * 10_007 + round_) * 0x9E3779B97F4A7C15 % (1 << 64)
    with np.errstate(over="ignore"):
        z = hashes.astype(np.uint64) ^ np.uint64(salt)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 1) / (1 << 53)


def _draw(df: DataFrame, n: int, starts: Sequence[Start], round_: int) -> None:
    """Add a center to every start: a row drawn with its squared distance from the nearest center as weight."""
    given = [(i, s.k, s.seed, s.centers) for i, s in enumerate(starts)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        best: dict[int, tuple] = {}
        for batch in batches:
            x, hashes = _columns(batch, n), batch.column(n).to_numpy(zero_copy_only=False)
            for i, k, seed, centers in given:
                for part in _blocks(x, len(centers)):
                    weight = _squared(x[part], centers).min(axis=1) if len(centers) else np.ones(len(x[part]))
                    if not (weight > 0).any():
                        continue
                    with np.errstate(divide="ignore"):
                        # the largest of log(u) / weight is a draw with these weights
                        key = np.where(weight > 0, np.log(_uniform(hashes[part], seed, k, round_)) / weight, -np.inf)
                    at = int(key.argmax())
                    found = (float(key[at]), x[part][at].tolist())
                    if i not in best or found > best[i]:
                        best[i] = found
        yield [(i, *found) for i, found in best.items()]

    drawn = _per_task(df, "start int, rank double, center array<double>", work).groupBy("start").agg(
        F.max(F.struct("rank", "center")).alias("best")).collect()  # a row per start
    for row in drawn:
        start = starts[row["start"]]
        start.centers = np.vstack([start.centers, row["best"]["center"]])


def move(df: DataFrame, n: int, starts: Sequence[Start]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per start the rows by center, the sums of their columns, and the cost; one scan and one aggregation for all."""
    given = [(i, s.centers) for i, s in enumerate(starts)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        counts = [np.zeros(len(c), np.int64) for _, c in given]
        sums, costs = [np.zeros(c.shape) for _, c in given], [np.zeros(len(c)) for _, c in given]
        for batch in batches:
            x = _columns(batch, n)
            for i, centers in given:
                for part in _blocks(x, len(centers)):
                    away = _squared(x[part], centers)
                    nearest = away.argmin(axis=1)
                    counts[i] += np.bincount(nearest, minlength=len(centers))
                    costs[i] += np.bincount(nearest, away[np.arange(len(nearest)), nearest], len(centers))
                    for j in range(n):
                        sums[i][:, j] += np.bincount(nearest, x[part][:, j], len(centers))
        yield [(i, c, int(counts[i][c]), float(costs[i][c]), sums[i][c].tolist())
               for i, centers in given for c in range(len(centers)) if counts[i][c]]

    total = _per_task(df, "start int, center int, n bigint, cost double, sums array<double>", work).groupBy("start", "center").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(n)])
    out = [(np.zeros(len(c), np.int64), np.zeros(c.shape), 0.0) for _, c in given]
    for row in total.collect():  # a row per start and center
        counts, sums, cost = out[row["start"]]
        counts[row["center"]] = row["n"]
        sums[row["center"]] = [row[f"s{j}"] for j in range(n)]
        out[row["start"]] = (counts, sums, cost + row["cost"])
    return out


def numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles and a hash of them; rows with a missing value are an error."""
    def whole(column: str):
        value = F.col(f"`{column}`").cast("double")
        return F.when(value.isNotNull() & ~F.isnan(value), value).otherwise(
            F.raise_error(F.lit(f"{column}: missing value")).cast("double"))

    values = df.select(*[whole(c).alias(f"x{i}") for i, c in enumerate(columns)])
    return values.select("*", F.xxhash64(*values.columns).alias("hash"))


def starts_of(df: DataFrame, columns: Sequence[str], ks: Sequence[int], n_init: int, seed: int) -> list[Start]:
    """Drawn centers for every k and start; fewer than k where there are not as many different rows."""
    if n_init < 1 or min(ks, default=1) < 1:
        raise ValueError("at least one cluster and one start")
    ship_package(df.sparkSession)
    starts = [Start(k, seed + i, np.empty((0, len(columns)))) for k in ks for i in range(n_init)]
    values = numbers(df, columns)
    for round_ in range(max(ks, default=0)):
        # a start that found no other row to add has all there are
        growing = [s for s in starts if round_ < s.k and len(s.centers) == round_]
        if growing:
            _draw(values, len(columns), growing, round_)
    return starts


def settle(df: DataFrame, columns: Sequence[str], starts: Sequence[Start], max_iter: int = 300, tol: float = 1e-4) -> None:
    """Move the centers of all starts until each has none that moves by more than ``tol``, at most ``max_iter`` times; then
    the costs of all are those of where they ended. A center that loses all its rows stays where it is."""
    ship_package(df.sparkSession)
    values, n = numbers(df, columns), len(columns)
    for _ in range(max_iter):
        moving = [s for s in starts if not s.settled and len(s.centers)]
        if not moving:
            break
        for start, (counts, sums, _) in zip(moving, move(values, n, moving)):
            new = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], start.centers)
            start.settled = bool(np.sqrt(((new - start.centers) ** 2).sum(axis=1)).max() <= tol)
            start.centers = new
    there = [s for s in starts if len(s.centers)]
    for start, (_, _, cost) in zip(there, move(values, n, there) if there else []):
        start.cost = cost


def best_of(starts: Sequence[Start], k: int) -> Start:
    """The start of the smallest cost; a later one has to be better by more than what sums differ by from run to run."""
    chosen, *others = [s for s in starts if s.k == k]
    for start in others:
        if start.cost < chosen.cost * (1 - 1e-9):
            chosen = start
    return chosen
