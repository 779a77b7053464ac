"""Running totals and exact quantiles over a whole table, without a single-task window.

For running totals the table is range-partitioned by the order and each row keeps its range number. Totals per range are
a small table (one row per range and group); their running sum is the offset of each range, and inside a
range an ordinary window does the rest. The numbered table is written once: range bounds are drawn from
a sample, so computing it twice could number rows differently.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def running_totals(df: DataFrame, order_by: Sequence[str], sums: Sequence[str],
                   within: Sequence[str] = ()) -> DataFrame:
    """Add ``before_<c>`` and ``all_<c>`` for each column of ``sums``: its total over all rows that sort earlier, and over
    all rows, per group of ``within``.

    ``within`` and ``order_by`` together must identify a row; aggregate by them first.
    """
    ranged = stored(
        df.repartitionByRange(*within, *order_by).withColumn("_range", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy(*within, "_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    earlier_ranges = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*within)
    offsets = totals.select(
        *within, "_range", *[F.coalesce(F.sum(f"_t_{c}").over(earlier_ranges), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(group).alias(f"all_{c}") for c in sums])
    earlier_rows = (Window.partitionBy(*within, "_range").orderBy(*order_by)
                    .rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.join(offsets, [*within, "_range"])
    return placed.select(
        *df.columns,
        *[(F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(earlier_rows), F.lit(0))).alias(f"before_{c}")
          for c in sums], *[f"all_{c}" for c in sums])


#: Equal parts that a range of values is cut into by one scan.
PARTS = 1024


@dataclass
class _Sought:
    """A rank of a column, counted from 0: it is among ``n`` values from ``low`` to ``high``, and ``below`` are smaller."""

    metric: str
    rank: int
    below: int
    low: float
    high: float


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbours: (metric, probability, value).

    The values that hold the wanted ranks are found by selection: a scan counts the values of each range that holds such a
    rank in ``PARTS`` equal parts, of which one is the next range, from its least to its largest value. It ends when that
    is one value, after a few scans. Values are neither sorted nor shuffled; a scan leaves ``PARTS`` counts per rank. NULLs
    are left out, NaN counts as larger than any other value. A column without values has no rows.
    """
    names = [f"v{i}" for i in range(len(columns))]
    values = stored(df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)]), "values")
    infinite = float("inf")

    def finite(name: str) -> Column:
        return F.when((F.col(name) > -infinite) & (F.col(name) < infinite), F.col(name))

    # one row: counts and limits of every column
    first = values.agg(*[F.struct(
        F.count(n).alias("all"), F.count(finite(n)).alias("finite"), F.count_if(F.col(n) == -infinite).alias("least"),
        F.count_if(F.col(n) == infinite).alias("most"), F.min(finite(n)).alias("low"), F.max(finite(n)).alias("high")).alias(n)
        for n in names]).first()
    found: dict[tuple[str, int], float] = {}
    seeking: list[_Sought] = []
    for n in names:
        of = first[n]
        for rank in sorted({f(p * (of["all"] - 1)) for p in probabilities for f in (math.floor, math.ceil)} if of["all"] else ()):
            if rank < of["least"]:
                found[n, rank] = -infinite
            elif rank >= of["least"] + of["finite"]:
                found[n, rank] = infinite if rank < of["least"] + of["finite"] + of["most"] else float("nan")
            else:
                seeking.append(_Sought(n, rank, of["least"], of["low"], of["high"]))
    while True:
        found |= {(s.metric, s.rank): s.low for s in seeking if s.low == s.high}
        seeking = [s for s in seeking if s.low < s.high]
        if not seeking:
            break
        _narrow(values, seeking)
    rows = []
    for c, n in zip(columns, names):
        if first[n]["all"]:
            for p in probabilities:
                rank = p * (first[n]["all"] - 1)
                lower, upper = found[n, math.floor(rank)], found[n, math.ceil(rank)]
                share = rank - math.floor(rank)
                rows.append((c, float(p), lower + (upper - lower) * share if lower != upper else lower))
    return df.sparkSession.createDataFrame(rows, "metric string, probability double, value double")


def _narrow(values: DataFrame, seeking: list[_Sought]) -> None:
    """Cut the ranges of all ranks that are still sought, in one scan; ranks of one range share its counts."""
    ranges = list(dict.fromkeys((s.metric, s.low, s.high) for s in seeking))
    entries = []
    for i, (name, low, high) in enumerate(ranges):
        v = F.col(name)
        # halves, so that the width of no range is too large for a double
        width = high / 2 - low / 2
        part = F.floor((v / 2 - low / 2) / width * PARTS).cast("int") if width else F.when(v > low, PARTS).otherwise(0)
        entries.append(F.when(v.between(low, high), F.struct(
            F.lit(i).alias("range"), F.greatest(F.least(part, F.lit(PARTS - 1)), F.lit(0)).alias("part"), v.alias("value"))))
    counted = values.select(F.inline(F.array_compact(F.array(*entries)))).groupBy("range", "part").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()  # ranges x PARTS rows
    parts: dict[int, list] = {}
    for row in sorted(counted, key=lambda r: r["part"]):
        parts.setdefault(row["range"], []).append(row)
    for s in seeking:
        for row in parts[ranges.index((s.metric, s.low, s.high))]:
            if s.rank < s.below + row["n"]:
                s.low, s.high = row["low"], row["high"]
                break
            s.below += row["n"]
