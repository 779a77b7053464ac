"""Sinks: Parquet tables, CSV extracts, JDBC, and the load order of the star schema."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Collection, Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup_first
from ..operators.quality import fk_drop, pk_check, type_conform
from ..schemas import NOT_NULL, PRIMARY_KEY, STAR, star_schema
from ..session import stored


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the table does not hold yet, one per key, so that a repeated load adds nothing.

    NULL counts as a key of its own; of rows that share a key the smallest is taken.
    """
    known = df.sparkSession.read.schema(df.schema).parquet(path).select(F.col(key).alias("_known"))
    new = dedup_first(df, key).join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    write_table(stored(new, "new-rows"), path)  # the table is read to the end before anything is added


class Star(dict[str, DataFrame]):
    """Written star tables by name; ``dropped`` counts the fact rows left out, per reference and in all, ``counts`` the
    rows written."""

    dropped: dict[str, int]
    counts: dict[str, int]


def create_star(spark: SparkSession, folder: str) -> Star:
    """Publish the five star tables, empty; what was there before is dropped."""
    with _version(spark, folder) as path:
        for name in STAR:
            write_table(spark.createDataFrame([], star_schema(name)), f"{path}/{name}", mode="error")
    return read_star(spark, folder)


def load_star(star: Mapping[str, DataFrame], folder: str, kinds: Mapping[str, Mapping[str, str]] = STAR,
              refs: bool = True, check: bool = True) -> Star:
    """Write the star tables, dimensions before the fact, publish them together, and return the written tables.

    Fact rows with dangling references are left out and counted (``refs``); the written types are enforced and a
    value that does not fit is an error, and so is a repeated or missing key (``check``). Counts of rows, of missing keys
    and of what is left out are observed while the tables are written; each is computed once, the fact too.

    The tables go to a folder of their own, and ``read_star`` finds them through a pointer that is set last, in one step.
    Until then, and so whatever fails before, readers have the tables of the load before, all of them. Loading again gives
    the same tables.
    """
    spark = next(iter(star.values())).sparkSession
    dropped: dict[str, int] = {}
    counts: dict[str, int] = {}
    with _version(spark, folder) as path:
        written: dict[str, DataFrame] = {}
        # the keys of the dimensions are known to be unique before the fact meets them
        for names in ([n for n in star if n != "fact_orders"], [n for n in star if n == "fact_orders"]):
            missing = {}
            for name in names:
                df, lost = star[name], None
                if name == "fact_orders" and refs:
                    lost = Observation("dropped")
                    df = fk_drop(df, [("customer_id", written["dim_customers"], False),
                                      ("product_id", written["dim_products"], True),
                                      ("seller_id", written["dim_sellers"], True)], lost, unique=check)
                seen = Observation("written")
                required = [F.count_if(F.col(c).isNull()).alias(c) for c in NOT_NULL.get(name, ()) if c in kinds[name]]
                typed = type_conform(df, kinds[name]).observe(seen, F.count("*").alias("*"), *required)
                write_table(typed, f"{path}/{name}", mode="error")
                written[name] = spark.read.schema(typed.schema).parquet(f"{path}/{name}")
                found = dict(seen.get)
                counts[name] = found.pop("*")
                missing |= {f"{name}: {n} x not null {c}": n for c, n in found.items()}
                dropped |= lost.get if lost else {}
            if check:
                repeated = reduce(DataFrame.unionByName, [
                    pk_check(written[n].select(PRIMARY_KEY[n]), PRIMARY_KEY[n]).agg(F.count("*").alias("n")).select(
                        F.lit(n).alias("name"), "n") for n in names]).collect() if names else []  # a row per table
                broken = [f"{r['name']}: {r['n']} x unique {PRIMARY_KEY[r['name']]}" for r in repeated if r["n"]]
                broken += [what for what, n in missing.items() if n]
                if broken:
                    raise ValueError("; ".join(broken))
    tables = read_star(spark, folder)
    tables.dropped, tables.counts = dropped, counts
    return tables


def read_star(spark: SparkSession, folder: str) -> Star:
    """The tables of the load that was published last; an error if there is none."""
    version = current_version(spark, folder)
    if version is None:
        raise FileNotFoundError(f"{folder}: nothing was published")
    path = f"{folder}/{VERSIONS}/{version}"
    star = Star({name: spark.read.parquet(f"{path}/{name}") for name in _names(spark, path)})
    star.dropped, star.counts = {}, {}
    return star


#: Below a star's folder: the tables of each load, and the pointers, the last of which names the load that counts.
VERSIONS, POINTERS = "versions", "pointers"
#: Loads that stay on disk, so that whoever reads the one before the last can go on.
KEPT_VERSIONS = 2


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The load that counts. A pointer is an empty file ``<number>-<version>`` that appears in one step, so there is
    nothing in it to be half written."""
    names = _names(spark, f"{folder}/{POINTERS}")
    return max(names).split("-", 1)[1] if names else None


@contextmanager
def _version(spark: SparkSession, folder: str) -> Iterator[str]:
    """A new folder for tables, published when the block ends and deleted if it fails."""
    version = uuid.uuid4().hex
    path = f"{folder}/{VERSIONS}/{version}"
    published = False
    try:
        yield path
        _publish(spark, folder, version)
        published = True
    finally:
        if not published and current_version(spark, folder) != version:
            _delete(spark, path)
    _tidy(spark, folder)


def _publish(spark: SparkSession, folder: str, version: str) -> None:
    """Create the next pointer. Two loads that end at once may take the same number; then the larger name counts, for all
    readers alike."""
    names = _names(spark, f"{folder}/{POINTERS}")
    number = int(max(names).split("-")[0]) + 1 if names else 1
    if not _claim(spark, f"{folder}/{POINTERS}/{number:012d}-{version}"):
        raise OSError(f"{folder}: cannot publish {version}")


def _claim(spark: SparkSession, path: str) -> bool:
    where, system = _path(spark, path)
    return system.createNewFile(where)


def _tidy(spark: SparkSession, folder: str) -> None:
    """Delete what older loads have left behind; a failure here changes no table."""
    try:
        pointers = sorted(_names(spark, f"{folder}/{POINTERS}"))
        for name in pointers[:-KEPT_VERSIONS]:
            _delete(spark, f"{folder}/{VERSIONS}/{name.split('-', 1)[1]}")
            _delete(spark, f"{folder}/{POINTERS}/{name}")
    except Exception as failed:  # the load itself is done
        warnings.warn(f"{folder}: older versions stay: {failed}")


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    where, system = _path(spark, path)
    return [entry.getPath().getName() for entry in system.listStatus(where)] if system.exists(where) else []


def _delete(spark: SparkSession, path: str) -> None:
    where, system = _path(spark, path)
    system.delete(where, True)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV. ``single_file`` is for report-sized results only: it writes with one task."""
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    # quotes inside quoted text are doubled
    writer.option("header", True).option("escape", '"').csv(path)


def export_all(reports: Mapping[str, Callable[[], DataFrame]], folder: str,
               single_file: Collection[str] = ()) -> list[tuple[str, str]]:
    """Run every report and write it to ``<folder>/<name>``; returns (name, path) pairs.

    Reports are written by as many tasks as they have; those named in ``single_file`` by one, which is for a few
    rows per state, month or status.
    """
    paths = []
    for name, build in reports.items():
        path = f"{folder}/{name}"
        write_csv(build(), path, single_file=name in single_file)
        paths.append((name, path))
    return paths


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Append to an external table; every partition opens its own connection."""
    df.write.format("jdbc").options(**options).option("url", url).option("dbtable", table).mode("append").save()

