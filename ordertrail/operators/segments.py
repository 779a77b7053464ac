"""Customer segmentation: K-Means over standardised columns, its quality, and named segments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import half_even, ratio
from ..session import spread
from . import kmeans
from .rfm import RFM

# Segment names from the highest to the lowest mean monetary value.
SEGMENT_NAMES = ["Champions", "Loyal", "At-Risk", "Lost"]
DEFAULT_K = 4
# a column of more different values is no assignment to clusters
MAX_CLUSTERS = 1000
SEED = 42


def as_vectors(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` cached inside the block, unless the caller already does."""
    ours = df.storageLevel == StorageLevel.NONE
    if ours:
        df.persist()
    try:
        yield df
    finally:
        if ours:
            df.unpersist()


def _best_fits(df: DataFrame, columns: Sequence[str], ks: Sequence[int], n_init: int, max_iter: int, tol: float, seed: int,
               ) -> list[kmeans.Start]:
    """Per k the start of the smallest cost, of ``n_init``; all starts of all k settle in the same passes."""
    with _kept(spread(df.select(*columns))) as rows:
        starts = kmeans.starts_of(rows, columns, ks, n_init, seed)
        kmeans.settle(rows, columns, starts, max_iter, tol)
    return [kmeans.best_of(starts, k) for k in ks]


def kmeans_fit(df: DataFrame, columns: Sequence[str], k: int, n_init: int = 10, max_iter: int = 300, tol: float = 1e-4,
               seed: int = SEED) -> kmeans.Start:
    """The fit with the smallest cost over ``n_init`` starts. Pass a stored table: every iteration reads it."""
    return _best_fits(df, columns, [k], n_init, max_iter, tol, seed)[0]


def kmeans_assign(df: DataFrame, columns: Sequence[str], k: int = DEFAULT_K, **fit) -> DataFrame:
    """Add ``cluster``, the nearest of ``k`` fitted centers."""
    return nearest_center(df, columns, kmeans_fit(df, columns, k, **fit).centers.tolist())


def nearest_center(df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``cluster``, the number of the nearest of the stated centers; of equally near ones the first."""
    if not centers or any(len(c) != len(columns) for c in centers):
        raise ValueError("every center needs one value per column")
    away = [sum(((F.col(c) - v) * (F.col(c) - v) for c, v in zip(columns, center)), F.lit(0.0)) for center in centers]
    ranked = F.array(*[F.struct(a.alias("away"), F.lit(i).alias("id")) for i, a in enumerate(away)])
    return df.withColumn("cluster", F.array_min(ranked)["id"])


def k_sweep(df: DataFrame, columns: Sequence[str], k_range: Sequence[int] = range(2, 9), n_init: int = 10,
            max_iter: int = 300, tol: float = 1e-4, seed: int = SEED) -> DataFrame:
    """Inertia and silhouette (squared Euclidean distance) per number of clusters; one row each."""
    ks = list(k_range)
    fits = _best_fits(df, columns, ks, n_init, max_iter, tol, seed)
    with _kept(spread(df.select(*columns))) as rows:
        scores = [silhouette(nearest_center(rows, columns, fit.centers.tolist()), columns).select(
            F.lit(k).alias("k"), F.lit(fit.cost).alias("inertia"), "silhouette") for k, fit in zip(ks, fits)]
        found = reduce(DataFrame.unionByName, scores).collect()  # a row per k
    return df.sparkSession.createDataFrame([tuple(r) for r in found], "k int, inertia double, silhouette double")


def choose_k(sweep: DataFrame | None = None, k: int = DEFAULT_K) -> int:
    """The stated ``k``; with a sweep, the one of the largest silhouette (smallest on ties)."""
    if sweep is None:
        return k
    return sweep.orderBy(F.desc("silhouette"), "k").first()["k"]


def inertia(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Sum of squared distances to the cluster means, for a given assignment."""
    spread = sum((F.var_pop(c) for c in columns), F.lit(0.0)) * F.count("*")
    return df.groupBy(cluster).agg(spread.alias("spread")).agg(F.sum("spread").alias("inertia"))


def silhouette_rows(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Add the silhouette (squared Euclidean distance) of every row, exactly and without pairs.

    The mean squared distance of a row to a cluster follows from the cluster's size, its vector sum
    and its sum of squared norms. These are one entry per cluster, gathered into one broadcast row; more than
    ``MAX_CLUSTERS`` are an error.
    """
    def norm(prefix: str = "") -> Column:
        return sum((F.col(prefix + c) * F.col(prefix + c) for c in columns), F.lit(0.0))

    per_cluster = df.groupBy(F.col(cluster).alias("id")).agg(
        F.count("*").alias("n"), F.sum(norm()).alias("sq"), *[F.sum(c).alias(f"s_{c}") for c in columns])
    few = F.when(F.count("*") <= MAX_CLUSTERS, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"{cluster}: more than {MAX_CLUSTERS} clusters")).cast("boolean"))
    one_row = per_cluster.limit(MAX_CLUSTERS + 1).agg(
        F.collect_list(F.struct(*per_cluster.columns)).alias("_clusters"), few.alias("_few")).where("_few").drop("_few")
    wide = df.crossJoin(F.broadcast(one_row))

    def total_distance(k: Column) -> Column:
        dot = sum((F.col(c) * k[f"s_{c}"] for c in columns), F.lit(0.0))
        return F.greatest(k["n"] * norm() - F.lit(2.0) * dot + k["sq"], F.lit(0.0))

    own = F.filter("_clusters", lambda k: k["id"] == F.col(cluster))[0]
    others = F.filter("_clusters", lambda k: k["id"] != F.col(cluster))
    a = total_distance(own) / (own["n"] - 1)
    b = F.array_min(F.transform(others, lambda k: total_distance(k) / k["n"]))
    scored = F.when(own["n"] == 1, F.lit(0.0)).otherwise(
        F.when(F.greatest(a, b) == 0, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b)))
    return wide.withColumn("silhouette", scored).drop("_clusters")


def silhouette(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean silhouette of an assignment (squared Euclidean distance), as one row."""
    return silhouette_rows(df, columns, cluster).agg(F.avg("silhouette").alias("silhouette"))


def _mean(column: str, places: int) -> Column:
    # summed as a decimal: the result does not depend on the order of the rows
    return half_even(ratio(F.sum(F.col(column).cast("decimal(20,2)")), F.count(column)), places)


def cluster_summary(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Mean recency, frequency and monetary value per cluster, two places, and its size."""
    return df.groupBy(cluster).agg(*[_mean(c, 2).alias(c) for c in RFM],
                                   F.count("customer_unique_id").alias("count"))


def segment_names(summary: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Name per cluster by falling mean monetary value; ties go by cluster id, and clusters beyond the
    named ones are called by their rank. The input is one row per cluster."""
    rank = F.row_number().over(Window.orderBy(F.desc("monetary"), cluster))
    names = F.array(*[F.lit(n) for n in SEGMENT_NAMES])
    named = F.when(rank <= len(SEGMENT_NAMES), F.get(names, rank - 1)).otherwise(
        F.concat(F.lit("Segment-"), rank.cast("string")))
    return summary.select(cluster, named.alias("segment"))


def assign_segments(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Add ``segment`` to every customer; the broadcast side is one row per cluster."""
    return df.join(F.broadcast(segment_names(cluster_summary(df, cluster), cluster)), cluster)


def segment_profile(df: DataFrame) -> DataFrame:
    """Mean recency, frequency and monetary value per segment, one place."""
    return df.groupBy("segment").agg(*[_mean(c, 1).alias(c) for c in RFM])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column)


def segment_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "segment")


def segments_export(df: DataFrame) -> DataFrame:
    return df.select("customer_unique_id", *RFM, "cluster", "segment")
