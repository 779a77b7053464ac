"""Sources: header CSV with stated schemas, Parquet, SQL text over views, JDBC."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import FREE_TEXT, RAW, raw_schema
from .split_csv import read_split_csv


def read_csv(spark: SparkSession, path: str, schema: StructType, corrupt: str | None = None,
             multi_line: bool = False, mixed_headers: bool = False) -> DataFrame:
    """Columns of header CSV files by name, with the stated types and no inference pass.

    Spark binds a stated schema by position, so the header is read ahead and every file's own header is checked
    against it: a folder whose files order their columns differently is an error when it is read. With
    ``mixed_headers`` the header of each file is read ahead instead, and files are read by the order they have;
    that is one short job per file. Columns outside the schema are not parsed. Lines that do not fit keep NULL in
    the fields that failed; with ``corrupt`` (the name of an additional column) the whole line is kept there.
    ``multi_line`` allows line breaks inside quoted text; such a file is read by one task, ``read_split_csv`` reads it by
    several.
    """
    # quotes inside quoted text are doubled
    options = {"header": "true", "escape": '"', "multiLine": str(multi_line).lower()}

    def header(paths: str | list[str]) -> list[str]:
        return spark.read.options(**options).csv(paths).columns

    def read(paths: str | list[str], present: list[str]) -> DataFrame:
        missing = [f.name for f in schema if f.name not in present and f.name != corrupt]
        if missing:
            raise ValueError(f"{paths}: no column {', '.join(missing)}")
        typed = {f.name: f for f in schema}
        full = StructType([typed.get(c, StructField(c, StringType())) for c in present])
        reader = spark.read.options(**options).option("mode", "PERMISSIVE").option("enforceSchema", "false")
        if corrupt:
            full = full.add(StructField(corrupt, StringType()))
            reader = reader.option("columnNameOfCorruptRecord", corrupt)
        wanted = [f.name for f in schema] + ([corrupt] if corrupt and corrupt not in typed else [])
        return reader.schema(full).csv(paths).select(*wanted)

    if not mixed_headers:
        return read(path, header(path))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        by_header.setdefault(tuple(header(file)), []).append(file)
    if not by_header:
        return read(path, header(path))
    return reduce(DataFrame.unionByName, [read(files, list(names)) for names, files in by_header.items()])


def load_raw(spark: SparkSession, folder: str, files: Mapping[str, str] | None = None, corrupt: str | None = None,
             multi_line: Collection[str] = FREE_TEXT, mixed_headers: bool = False) -> dict[str, DataFrame]:
    """All raw tables by name; ``files`` maps a table to its file name (``<table>.csv`` if absent).

    With ``corrupt`` every table gets that column with the lines that do not fit their types; ``quarantine_raw``
    sets them aside. ``multi_line`` names the tables whose text may hold line breaks: their files are read in splits by
    ``read_split_csv``, or with ``mixed_headers`` by one task each.
    """
    files = files or {}

    def read(name: str) -> DataFrame:
        path = f"{folder}/{files.get(name, name + '.csv')}"
        if name in multi_line and not mixed_headers:
            return read_split_csv(spark, path, raw_schema(name), corrupt)
        return read_csv(spark, path, raw_schema(name), corrupt, multi_line=name in multi_line, mixed_headers=mixed_headers)

    return {name: read(name) for name in RAW}


def quarantine_raw(raw: Mapping[str, DataFrame], corrupt: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Tables read with ``corrupt`` as (rows that fit, rows that do not, with their line), both by name."""
    fits = {name: df.filter(F.col(corrupt).isNull()).drop(corrupt) for name, df in raw.items()}
    return fits, {name: df.filter(F.col(corrupt).isNotNull()) for name, df in raw.items()}


def unparsed_counts(raw: Mapping[str, DataFrame], corrupt: str) -> DataFrame:
    """Per table and column how many lines that do not fit have no value there, and ``*`` for the lines themselves."""
    parts = []
    for name, df in raw.items():
        broken = F.col(corrupt).isNotNull()
        columns = [c for c in df.columns if c != corrupt]
        counts = df.agg(F.count_if(broken).alias("*"), *[F.count_if(broken & F.col(c).isNull()).alias(c) for c in columns])
        rows = F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column"), F.col(f"`{c}`").alias("rows"))
                         for c in counts.columns])
        parts.append(counts.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts).filter("rows > 0")


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None, **args) -> DataFrame:
    """Run SQL text. ``tables`` are named inputs, written ``{name}`` in the text; ``args`` are bound
    parameters, written ``:name``, and never spliced into the text."""
    return spark.sql(text, args or None, **(tables or {}))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
              partitions: int, **options: str) -> DataFrame:
    """Read an external table in ``partitions`` parallel key ranges."""
    return (
        spark.read.format("jdbc").options(**options)
        .option("url", url).option("dbtable", table)
        .option("partitionColumn", key).option("lowerBound", lower).option("upperBound", upper)
        .option("numPartitions", partitions).load()
    )


def load_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named frame, as one job."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)
