"""Named queries: a callable over the bundled tables and, where SQL can say it, the same as SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType

from .oracle_tables import with_tables
from .tables import Tables


@dataclass
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated ``Tables -> DataFrame`` function."""
    def add(build: Callable[[Tables], DataFrame]):
        assert name not in CATALOG, name
        CATALOG[name] = Query(build, sql)
        return build
    return add


def comparable(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles and booleans as integers, so that both engines return the same types."""
    casts = {BooleanType: "int", DecimalType: "double"}
    found = {f.name: casts[type(f.dataType)] for f in df.schema if type(f.dataType) in casts}
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in found.items()}) if found else df


def rounded(df: DataFrame, places: int = 6, *columns: str) -> DataFrame:
    """Round floating results, whose last digits depend on the order of summation."""
    names = columns or [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(F.col(c).cast("decimal(38,10)"), places).cast("double") for c in names})


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(q: Query):
        return lambda spark, folder: comparable(q.build(Tables(spark, folder)))
    return {name: runner(q) for name, q in CATALOG.items()}


def oracles() -> dict[str, str]:
    return {name: with_tables(q.sql) for name, q in CATALOG.items() if q.sql}
