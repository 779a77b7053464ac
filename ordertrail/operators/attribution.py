"""Per-feature attributions of boosted trees, computed where the rows are.

The trees are small (trees x leaves) and travel to the tasks; the customer rows stay distributed. What a leaf adds to the
margin depends on the features tested on the way to it: a known feature passes its tests or not, an unknown one passes with
the share of the rows that did in training. A feature's Shapley value in this game comes from the coefficients of one
polynomial per leaf, in time that grows with the square of the number of features on the path, not with its power of two.

They depend on nothing but the leaf and which of its tests a row passes. Where a tree has fewer such patterns than a batch
has rows, the polynomials are worked out once per pattern, and a row looks its own up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, spread
from .boosting import BoostedTrees, Tree

#: Tests of rows, or polynomials, that are in memory at a time.
HELD = 500_000


@dataclass
class Leaves:
    """The leaves of one tree, padded to the same number ``m`` of tested features.

    ``feature``, ``low``, ``high``, ``missing``, ``share``: (leaves, m); a value passes if low <= value < high, a missing one
    if ``missing``, and ``share`` of the rows did. A padded entry passes always. ``used`` is the number of real ones.
    """

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    missing: np.ndarray
    share: np.ndarray
    used: np.ndarray
    value: np.ndarray

    @property
    def base(self) -> float:
        """The margin with no feature known."""
        return float((self.value * self.share.prod(axis=1)).sum())


def leaves(tree: Tree) -> Leaves:
    """Paths to all leaves, with the tests of a feature that is met several times taken as one."""
    found, todo = [], [(0, {})]
    while todo:
        node, path = todo.pop()
        feature = int(tree.feature[node])
        if feature < 0:
            found.append((float(tree.value[node]), path))
            continue
        low, high, missing, share = path.get(feature, (-np.inf, np.inf, True, 1.0))
        cut, to_left = float(tree.cut[node]), bool(tree.missing_left[node])
        for child, bounds, passes in ((2 * node + 1, (low, min(high, cut)), to_left),
                                      (2 * node + 2, (max(low, cut), high), not to_left)):
            part = float(tree.cover[child] / tree.cover[node])
            todo.append((child, path | {feature: (*bounds, missing and passes, share * part)}))
    m = max(1, max(len(path) for _, path in found))
    shape = (len(found), m)
    out = Leaves(np.zeros(shape, int), np.full(shape, -np.inf), np.full(shape, np.inf), np.ones(shape, bool), np.ones(shape),
                 np.array([len(path) for _, path in found]), np.array([value for value, _ in found]))
    for row, (_, path) in enumerate(found):
        for column, (feature, test) in enumerate(path.items()):
            out.feature[row, column] = feature
            out.low[row, column], out.high[row, column], out.missing[row, column], out.share[row, column] = test
    return out


def tests_passed(of: Leaves, x: np.ndarray) -> np.ndarray:
    """Which tests of every leaf the rows pass: (rows, leaves, m)."""
    values = x[:, of.feature]
    within = (values >= of.low) & ((values < of.high) | (of.high == np.inf))
    return np.where(np.isnan(values), of.missing, within)


def contributions(of: Leaves, tests: np.ndarray) -> np.ndarray:
    """What every tested feature of every leaf adds, by the tests that are passed: both (rows, leaves, m).

    With o = 1 for a passed test and z its share, the coefficient k of the product of all z + o t is the sum over all sets
    of k known features of what is left of the leaf's value. Dividing by a feature's own factor leaves the sums over sets
    without it, and these are weighted by how many orders of the features put such a set before it.
    """
    m = of.feature.shape[1]
    passed = tests.astype(float)
    # an entry that only fills up has the factor 1
    passed[:, np.arange(m)[None, :] >= of.used[:, None]] = 0.0
    product = np.zeros((*passed.shape[:2], m + 1))
    product[..., 0] = 1.0
    for i in range(m):
        o, z = passed[..., i, None], of.share[:, i, None]
        product[..., 1:] = product[..., 1:] * z + product[..., :-1] * o
        product[..., 0] *= of.share[:, i]
    # of a leaf of n features, sets of k
    weight = np.zeros((len(of.used), m))
    for leaf, n in enumerate(of.used.tolist()):
        for k in range(n):
            weight[leaf, k] = factorial(k) * factorial(n - k - 1) / factorial(n)
    out = np.empty_like(passed)
    for i in range(m):
        o, z = passed[..., i], of.share[:, i]
        # synthetic division by z + t from the highest power down, or by z alone
        rest, total = np.zeros(o.shape), np.zeros(o.shape)
        for k in range(m - 1, -1, -1):
            rest = product[..., k + 1] - z * rest
            total += weight[:, k] * np.where(o == 1, rest, product[..., k] / z)
        out[..., i] = of.value * (o - z) * total
    out[:, np.arange(m)[None, :] >= of.used[:, None]] = 0.0
    return out


def _by_feature(of: Leaves, parts: np.ndarray, features: int) -> np.ndarray:
    """Parts (rows, leaves, m) added up to (rows, leaves, features); a feature is once on a path."""
    out = np.zeros((*parts.shape[:2], features))
    for i in range(parts.shape[2]):
        out[:, np.arange(len(of.used)), of.feature[:, i]] += parts[..., i]
    return out


def by_pattern(of: Leaves, features: int) -> np.ndarray:
    """What every leaf adds to each feature for every pattern of passed tests: (leaves x patterns, features); the first test
    is the lowest bit of a pattern's number."""
    m = of.feature.shape[1]
    tests = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(bool)
    parts = contributions(of, np.broadcast_to(tests[:, None], (1 << m, *of.feature.shape)))
    return _by_feature(of, parts, features).transpose(1, 0, 2).reshape(-1, features)


def _attribute(tables: Sequence[Leaves], x: np.ndarray) -> np.ndarray:
    out, features = np.zeros(x.shape), x.shape[1]
    for of in tables:
        n, m = of.feature.shape
        known = by_pattern(of, features) if 1 << m < len(x) and n << m <= HELD // m else None
        step = max(1, HELD // (n * max(m, features)))
        for at in range(0, len(x), step):
            tests = tests_passed(of, x[at:at + step])
            if known is None:
                out[at:at + step] += _by_feature(of, contributions(of, tests), features).sum(axis=1)
            else:
                pattern = (tests << np.arange(m)).sum(axis=2)
                out[at:at + step] += known[pattern + (np.arange(n) << m)].sum(axis=1)
    return out


def attributions(model: BoostedTrees, df: DataFrame, key: str = "customer_unique_id") -> DataFrame:
    """Contribution of every feature to each row's margin: key, ``base`` and one column per feature of the model.

    The contributions and ``base`` add up to the margin, whatever the depth of the trees.
    """
    tables = [leaves(tree) for tree in model.trees]
    ship_package(df.sparkSession)
    base = sum(t.base for t in tables)
    names = model.columns

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[names].to_numpy(dtype=float)
            out = pd.DataFrame(_attribute(tables, x), columns=names)
            out.insert(0, "base", base)
            out.insert(0, key, batch[key].to_numpy())
            yield out

    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, base double, " + ", ".join(
        f"`{c}` double" for c in names)
    values = df.select(key, *[F.col(c).cast("double").alias(c) for c in names])
    return spread(values).mapInPandas(attribute, schema)


def mean_attribution(contributions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    wide = contributions.agg(*[F.avg(F.abs(c)).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs")) for c in columns])
    return wide.select(F.inline(rows)).orderBy(F.desc("mean_abs"), "feature")
