"""Second-order boosted trees for a 0/1 label, fitted by one aggregation per level of a tree.

Values are binned once by a quantile sketch; a missing value has a bin of its own and every split learns the side it goes
to. A level of a tree needs the sums of gradients and hessians by node, feature and bin. The sums
are of fixed-point numbers, so they, and with them the trees, do not depend on the order or the partitioning of the rows.

``histograms`` is this aggregation as a DataFrame. A fit needs it some 1,500 times, one after the other, and there planning
a query takes several times as long as its work on small tables; so ``fit`` keeps the binned rows in memory as blocks of
arrays, adds up arrays of the same sums by node with ``reduceByKey`` and finds the best split of a node where its sums are.
Only these splits, a few numbers per node, reach the driver, whatever the number of rows and tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, spread, stored

#: One in fixed point: nine places, and room for some 8e9 rows of weight 1 in a sum.
ONE = 1 << 30
MISSING = -1
#: Every tree adds to the margins kept next to the rows; after so many they are made again from the binned rows, so that
#: what a lost task needs is a short chain.
KEPT_EVERY = 25
#: Rows in a block, rows in a task at most, and those that are worth a task of their own while cores are idle.
BLOCK_ROWS, TASK_ROWS, LEAST_ROWS = 50_000, 500_000, 50_000
#: Nodes whose sums a task adds up.
NODES = 4


@dataclass
class Tree:
    """Nodes by place: the children of n are 2n + 1 and 2n + 2. ``feature`` is -1 at a leaf; at others values below
    ``cut`` (the ``bin``-th bin and up are not) and, if ``missing_left``, missing ones go left. ``value`` is what a leaf
    adds to the margin, ``cover`` the hessians of the rows that reached a node."""

    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, int), np.zeros(n), np.zeros(n, bool), np.zeros(n), np.zeros(n))


@dataclass
class BoostedTrees:
    """A fitted model; its margin is the sum of what the leaves that a row reaches add."""

    columns: list[str]
    trees: list[Tree] = field(default_factory=list)

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per node that rows reached: tree, node, feature, bin, cut, missing_left, value, cover."""
        rows = [(t, n, int(x.feature[n]), int(x.bin[n]), float(x.cut[n]), bool(x.missing_left[n]), float(x.value[n]),
                 float(x.cover[n])) for t, x in enumerate(self.trees) for n in range(len(x.feature)) if x.cover[n] > 0]
        return spark.createDataFrame(rows, "tree int, node int, feature int, bin int, cut double, missing_left boolean, "
                                           "value double, cover double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.parquet(f"{path}/nodes")
        spark.createDataFrame([(self.columns,)], "columns array<string>").coalesce(1).write.parquet(f"{path}/columns")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedTrees":
        model = cls(list(spark.read.parquet(f"{path}/columns").first()["columns"]))
        # the model's own nodes: trees x 2**(depth + 1) at most
        rows = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        last = max((r["node"] for r in rows), default=0)
        depth = (last + 1).bit_length() - 1
        for r in rows:
            if r["tree"] == len(model.trees):
                model.trees.append(Tree.empty(depth))
            tree, n = model.trees[r["tree"]], r["node"]
            tree.feature[n], tree.bin[n], tree.cut[n] = r["feature"], r["bin"], r["cut"]
            tree.missing_left[n], tree.value[n], tree.cover[n] = r["missing_left"], r["value"], r["cover"]
        return model

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margins of rows of values, NaN where missing."""
        out = np.zeros(len(x))
        rows = np.arange(len(x))
        for tree in self.trees:
            node = np.zeros(len(x), int)
            while True:
                feature = tree.feature[node]
                inner = feature >= 0
                if not inner.any():
                    break
                value = x[rows, np.maximum(feature, 0)]
                left = np.where(np.isnan(value), tree.missing_left[node], (value < tree.cut[node]) | (tree.cut[node] == np.inf))
                node = np.where(inner, 2 * node + 2 - left, node)
            out += tree.value[node]
        return out


def _number(column: str) -> Column:
    """A column as a double, null and NaN both as null."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def cut_points(df: DataFrame, columns: Sequence[str], max_bins: int = 256, accuracy: int = 10_000) -> list[list[float]]:
    """Per column the values that bins start from: quantiles by Spark's sketch and the largest value, but not the smallest,
    and last infinity, which parts values from missing ones.

    Of a column with no more values than bins these are its values, but for those too rare to be a quantile.
    """
    shares = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    # one row of max_bins numbers a column
    row = df.agg(*[F.percentile_approx(_number(c), shares, accuracy).alias(f"q{i}") for i, c in enumerate(columns)],
                 *[F.min(_number(c)).alias(f"low{i}") for i, c in enumerate(columns)],
                 *[F.max(_number(c)).alias(f"high{i}") for i, c in enumerate(columns)]).first()
    return [sorted({q for q in [*(row[f"q{i}"] or []), row[f"high{i}"]] if q is not None and q > row[f"low{i}"]} | {np.inf})
            for i in range(len(columns))]


def binned(df: DataFrame, columns: Sequence[str], cuts: Sequence[Sequence[float]], output: str = "bins") -> DataFrame:
    """Add ``output``: per column how many of its cuts the value reaches, and -1 where it is missing."""
    names = [(f"-value-{i}", f"-bin-{i}") for i in range(len(columns))]
    valued = df.withColumns({v: F.coalesce(_number(c), F.lit(float("nan"))) for (v, _), c in zip(names, columns)})
    edges = [[-np.inf, *(x for x in c if x < np.inf), np.inf] for c in cuts]
    # a column without cuts has one bin, and the bucketizer wants two
    cut = [i for i, e in enumerate(edges) if len(e) > 2]
    if cut:
        valued = Bucketizer(splitsArray=[edges[i] for i in cut], inputCols=[names[i][0] for i in cut],
                            outputCols=[names[i][1] for i in cut], handleInvalid="keep").transform(valued)
    bins = [F.when(F.isnan(f"`{v}`"), F.lit(MISSING)).otherwise(F.col(f"`{b}`") if i in cut else F.lit(0)).cast("int")
            for i, (v, b) in enumerate(names)]
    return valued.withColumn(output, F.array(*bins)).drop(*[n for pair in names for n in pair])


def with_gradients(df: DataFrame, probability: Column, label: str, weight: Column) -> DataFrame:
    """Add ``g`` and ``h``, first and second derivative of the log loss by the margin, weighted, in fixed point."""
    p = probability
    return df.withColumns({
        "g": F.round((p - F.col(label)) * weight * ONE).cast("bigint"), "h": F.round(p * (1 - p) * weight * ONE).cast("bigint")})


def histograms(df: DataFrame, node: str = "node", bins: str = "bins") -> DataFrame:
    """Sums of ``g`` and ``h`` by (node, feature, bin), in fixed point; features by their place in ``bins``.

    Sums are made in each task before the shuffle, so a row takes part in no shuffle and no bin can be too hot.
    """
    return df.select(F.col(node).alias("node"), "g", "h", F.posexplode(bins).alias("feature", "bin")).groupBy(
        "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


@dataclass(frozen=True)
class Penalty:
    """L2 penalty of leaf values and least hessian of a child."""

    l2: float = 1.0
    least: float = 1.0


def dense(sums: pd.DataFrame, cuts: Sequence[Sequence[float]]) -> tuple[list[int], np.ndarray]:
    """Nodes, and the sums of ``histograms`` as an array: g and h, node, feature, bin, the last of which is the missing one."""
    nodes = np.unique(sums["node"].to_numpy())
    table = np.zeros((2, len(nodes), len(cuts), _widest(cuts) + 1), np.int64)
    at = (np.searchsorted(nodes, sums["node"].to_numpy()), sums["feature"].to_numpy(), sums["bin"].to_numpy())
    for i, name in enumerate(("g", "h")):
        table[i][at] = sums[name].to_numpy()
    return nodes.tolist(), table


def _widest(cuts: Sequence[Sequence[float]]) -> int:
    return max((len(c) for c in cuts), default=0) + 1


def best_splits(nodes: Sequence[int], table: np.ndarray, cuts: Sequence[Sequence[float]], penalty: Penalty = Penalty(),
                ) -> dict[int, dict]:
    """Per node its totals ``g`` and ``h`` and, if one gains, the split: feature, bin, missing_left, gain and the sums of
    the left side. Of equal gains the first feature, the smallest bin, and missing values to the left are taken.

    ``table`` holds the sums as ``dense`` has them, of a size given by nodes, features and bins.
    """
    total = table[:, :, :1].sum(axis=-1)  # the same for every feature
    below = np.cumsum(table[..., :-1], axis=-1)[..., :-1]  # of values under the cut
    left = np.stack([below + table[..., -1:], below], axis=-1)  # missing values to the left, to the right
    right = total[..., None, None] - left

    def score(sums: np.ndarray) -> np.ndarray:
        return (sums[0] / ONE) ** 2 / (sums[1] / ONE + penalty.l2)

    gain = score(left) + score(right) - score(total)[..., None, None]
    possible = (left[1] >= penalty.least * ONE) & (right[1] >= penalty.least * ONE)
    for f, c in enumerate(cuts):
        possible[:, f, len(c):] = False
    gain = np.where(possible, gain, -np.inf).reshape(len(nodes), -1) if left.size else np.full((len(nodes), 1), -np.inf)
    out = {}
    for i, node in enumerate(nodes):
        found = {"g": int(total[0, i, 0]), "h": int(total[1, i, 0])}
        # gains that differ in rounding only count as equal
        top = gain[i].max()
        if top > 1e-6:
            first = int(np.flatnonzero(gain[i] >= top * (1 - 1e-12))[0])
            f, b, side = np.unravel_index(first, left.shape[2:])
            found |= {"feature": int(f), "bin": int(b) + 1, "missing_left": side == 0, "gain": float(top),
                      "left_g": int(left[0, i, f, b, side]), "left_h": int(left[1, i, f, b, side])}
        out[node] = found
    return out


def _pack(df: DataFrame) -> DataFrame:
    """Rows (y, bins) as rows of blocks: bytes of the labels, of the bins by row, and their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                # -1, a missing value, is the last number of two bytes
                bins = part.column(1).flatten().to_numpy().astype(np.uint16).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column(0).to_numpy().astype(np.uint8).tobytes()], pa.binary()), pa.array([bins], pa.binary()),
                     pa.array([part.num_rows], pa.int64())], names=["y", "bins", "n"])

    return df.select(F.col("y").cast("int"), "bins").mapInArrow(run, "y binary, bins binary, n bigint")


@dataclass
class Block:
    """Labels, bins (row, feature) with missing ones last, and margins of some rows."""

    y: np.ndarray
    bins: np.ndarray
    margin: np.ndarray

    def after(self, tree: Tree, levels: int, missing: int) -> np.ndarray:
        """Where the rows are after some steps from the root; at a leaf they stay."""
        node = np.zeros(len(self.y), int)
        rows = np.arange(len(self.y))
        for _ in range(levels):
            feature = tree.feature[node]
            value = self.bins[rows, np.maximum(feature, 0)]
            left = np.where(value == missing, tree.missing_left[node], value < tree.bin[node])
            node = np.where(feature < 0, node, 2 * node + 2 - left)
        return node

    def grown(self, trees: Sequence[Tree], levels: int, missing: int) -> "Block":
        """The same rows with what the trees add to their margins."""
        margin = self.margin.copy()
        for tree in trees:
            margin += tree.value[self.after(tree, levels, missing)]
        return Block(self.y, self.bins, margin)


def _tasks(rows: int, cores: int) -> int:
    """Tasks for so many rows: all cores if there is enough to do, and more where tasks would get too large."""
    return max(1, -(-rows // TASK_ROWS), min(cores, -(-rows // LEAST_ROWS)))


def fit(train: DataFrame, columns: Sequence[str], label: str, rounds: int = 300, depth: int = 5, rate: float = 0.05,
        positive_weight: float = 1.0, penalty: Penalty = Penalty(), max_bins: int = 256) -> BoostedTrees:
    """Fit ``rounds`` trees of at most ``depth`` levels; positive rows weigh ``positive_weight``.

    Rows without a label are left out. The rows are binned once and written; what is kept in memory besides can be made
    again from that and the trees. Every level of a tree is one pass over the rows, whose sums are added up node by node.
    """
    if rounds < 0 or depth < 1 or not 2 <= max_bins < 1 << 15:
        raise ValueError("rounds, depth or max_bins out of range")
    spark, names = train.sparkSession, list(columns)
    ship_package(spark)
    given = train.where(F.col(label).isNotNull())
    cuts = cut_points(given, names, max_bins)
    packed = stored(_pack(binned(given, names, cuts).select(F.col(label).alias("y"), "bins")), "binned")
    tasks = _tasks(packed.agg(F.sum("n")).first()[0] or 0, spark.sparkContext.defaultParallelism)
    missing, features = _widest(cuts), len(names)
    model = BoostedTrees(names)

    def ready(rows: Iterator) -> Iterator[Block]:
        def block(found: list) -> Block:
            bins = np.frombuffer(b"".join(r["bins"] for r in found), np.uint16).reshape(-1, features)
            y = np.frombuffer(b"".join(r["y"] for r in found), np.uint8)
            return Block(y, np.minimum(bins, np.uint16(missing)), np.zeros(len(y)))

        # what Arrow brings in small batches is put together again
        found, n = [], 0
        for row in rows:
            if found and n + row["n"] > BLOCK_ROWS:
                yield block(found)
                found, n = [], 0
            found.append(row)
            n += row["n"]
        if found:
            yield block(found)

    def grown(rows, trees: list[Tree]):
        return rows.map(lambda block: block.grown(trees, depth, missing)).persist(StorageLevel.MEMORY_AND_DISK)

    def level_splits(rows, tree: Tree, level: int) -> dict[int, dict]:
        first, shape = 2 ** level - 1, (2 ** level, features, missing + 1)

        def add(given: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
            total = np.zeros((2, *shape), np.int64)
            for block in given:
                p = 1 / (1 + np.exp(-block.margin))
                weight = np.where(block.y == 1, positive_weight, 1.0) * ONE
                node = block.after(tree, level, missing) - first
                active = node >= 0
                at = np.ravel_multi_index((node[active, None], np.arange(features)[None, :], block.bins[active]), shape)
                for i, values in enumerate(((p - block.y) * weight, p * (1 - p) * weight)):
                    # whole numbers, so sums of a block are exact in floating point too
                    repeated = np.repeat(np.rint(values[active]), features)
                    total[i] += np.bincount(at.ravel(), repeated, total[i].size).astype(np.int64).reshape(shape)
            for n in range(shape[0]):
                if total[1, n, 0].any():
                    yield n + first, total[:, n]

        def split(found: tuple[int, np.ndarray]) -> tuple[int, dict]:
            node, sums = found
            return node, best_splits([node], sums[:, None], cuts, penalty)[node]

        # a node of a task is one array, and a few numbers per node come back
        sums = rows.mapPartitions(add)
        if tasks > 1:
            sums = sums.reduceByKey(np.add, min(tasks, -(-2 ** level // NODES)))
        return dict(sorted(sums.map(split).collect()))

    blocks = packed.repartition(tasks).rdd.mapPartitions(ready).persist(StorageLevel.MEMORY_AND_DISK)
    rows, before = blocks, None
    for number in range(rounds):
        tree = Tree.empty(depth)
        for level in range(depth):
            found = level_splits(rows, tree, level)
            if before is not None:  # the first pass has made the margins from these
                before.unpersist()
                before = None
            if not _grow(tree, found, cuts, rate, penalty):
                break
        model.trees.append(tree)
        before = None if rows is blocks else rows
        rows = grown(rows, [tree]) if (number + 1) % KEPT_EVERY else grown(blocks, model.trees[:])
    for kept in (before, rows, blocks):
        if kept is not None:
            kept.unpersist()
    return model


def _grow(tree: Tree, found: dict[int, dict], cuts: Sequence[Sequence[float]], rate: float, penalty: Penalty) -> bool:
    """Put the splits of a level into the tree, and what their children add as leaves; False if nothing was split."""
    def leaf(n: int, g: int, h: int) -> None:
        tree.cover[n], tree.value[n] = h / ONE, -rate * (g / ONE) / (h / ONE + penalty.l2)

    grown = False
    for n, s in found.items():
        leaf(n, s["g"], s["h"])
        if "feature" in s:
            grown = True
            tree.feature[n], tree.bin[n], tree.missing_left[n] = s["feature"], s["bin"], s["missing_left"]
            tree.cut[n] = cuts[s["feature"]][s["bin"] - 1]
            leaf(2 * n + 1, s["left_g"], s["left_h"])
            leaf(2 * n + 2, s["g"] - s["left_g"], s["h"] - s["left_h"])
    return grown


def margin(model: BoostedTrees, df: DataFrame, output: str = "margin") -> DataFrame:
    """Add ``output``, the model's margin. Trees travel to the tasks; whole batches of rows go down them at once."""
    trees = model
    ship_package(df.sparkSession)

    @F.pandas_udf("double")
    def walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(trees.margins(np.column_stack([c.to_numpy(float) for c in batch])))

    return spread(df).withColumn(output, walk(*[_number(c) for c in model.columns]))
