"""Header CSV with line breaks inside quotes, read by as many tasks as a file has splits.

Whether a line break ends a record depends on all quotes before it. A first pass tells per split whether its quotes are even
or odd; the running total over the splits of a file, a row each, says for every split whether it starts inside quotes. A
second pass then joins lines to records where they lie. Only what a split's border cuts through, a piece on each side, is
shuffled and put together. Records are parsed by ``from_csv``, which knows what the CSV reader knows.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ship_package

WHOLE, HEAD, TAIL, INNER = range(4)
#: Bytes of records that a task sends on at once.
SENT = 4_000_000


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, list]]:
    """(file, start of the split, rows) of a batch of (file, split, ...) rows, in their order."""
    columns = [c.to_pylist() for c in batch.columns]
    rows = list(zip(*columns))
    at = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i][:2] != rows[at][:2]:
            yield rows[at][0], rows[at][1], rows[at:i]
            at = i


def split_quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, split, odd) for parts of splits: whether they hold an odd number of quotes."""
    for batch in batches:
        found = [(file, split, sum(row[2].count('"') for row in rows) % 2) for file, split, rows in _runs(batch)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()),
             pa.array([f[2] for f in found], pa.int32())], names=["file", "split", "odd"])


class _Joiner:
    """Records from the lines of one split: what comes before the first border of a record, what lies between two, and what
    is open at the end. A split without a border is one piece."""

    def __init__(self, file: str, split: int, inside: bool):
        self.file, self.split, self.inside = file, split, inside
        self.lines: list[str] = []
        self.bordered = not inside

    def add(self, line: str) -> tuple | None:
        self.lines.append(line)
        self.inside ^= line.count('"') % 2
        if self.inside:
            return None
        kind, self.bordered = (WHOLE if self.bordered else HEAD), True
        record, self.lines = "\n".join(self.lines), []
        return self.file, self.split, kind, record

    def end(self) -> tuple | None:
        return (self.file, self.split, TAIL if self.bordered else INNER, "\n".join(self.lines)) if self.lines else None


def join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, split, kind, record) from rows (file, split, line, inside) in the order of the file."""
    joiner, out, size = None, [], 0

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.string()))],
            names=["file", "split", "kind", "record"])

    for batch in batches:
        for file, split, rows in _runs(batch):
            if joiner is None or (joiner.file, joiner.split) != (file, split):
                out += [joiner.end()] if joiner and joiner.lines else []
                joiner = _Joiner(file, split, bool(rows[0][3]))
            for row in rows:
                found = joiner.add(row[2])
                if found:
                    out.append(found)
                    size += len(found[3]) + 32
                    if size >= SENT:
                        yield batch_of(out)
                        out, size = [], 0
    if joiner and joiner.lines:
        out.append(joiner.end())
    yield batch_of(out)


def read_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, first, record): the records of files, with line breaks in quotes; ``first`` marks the first of each file.

    Quotes inside quoted text are doubled; a quote in a field without quotes would be taken for one that opens.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")
    quotes = lines.mapInArrow(split_quotes, "file string, split bigint, odd int").groupBy("file", "split").agg(
        F.sum("odd").alias("odd"))
    # a row per split from here on
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = quotes.select(F.col("file").alias("_file"), F.col("split").alias("_split"),
                           (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    # an outer join keeps the lines in their order only if it does not shuffle them; the rows of splits are few enough to send
    known = lines.join(F.broadcast(starts), (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split")))
    pieces = known.select("file", "split", "value", "inside").mapInArrow(
        join_lines, "file string, split bigint, kind int, record string")
    # the first record of a file starts in its first split, and is whole or that split's only piece
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "split", "record")
    cut = pieces.where(F.col("kind") != WHOLE)
    in_file = Window.partitionBy("file").orderBy("split", F.when(F.col("kind") == HEAD, 0).otherwise(1))
    number = F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(in_file.rowsBetween(Window.unboundedPreceding, 0))
    rejoined = cut.withColumn("number", number).groupBy("file", "number").agg(
        F.min("split").alias("split"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "record"))), lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(rejoined.select("file", "split", "record")).select(
        "file", "split", F.regexp_replace("record", "\r$", "").alias("record"))


def read_split_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType, corrupt: str | None = None) -> DataFrame:
    """Columns of header CSV files by name, like ``read_csv`` with line breaks in quotes, but with several tasks a file.

    All files have the header of the first. The header's record and blank lines are left out. With ``corrupt`` a record that
    does not fit keeps its text there.
    """
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return spark.createDataFrame([], StructType([*schema.fields, *([StructField(corrupt, StringType())] if corrupt else [])]))
    header = first[0]["value"].removeprefix("﻿").rstrip("\r")
    present = next(csv.reader([header]))
    missing = [f.name for f in schema if f.name not in present and f.name != corrupt]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    typed = {f.name: f for f in schema}
    full = StructType([typed.get(c, StructField(c, StringType())) for c in present])
    options = {"escape": '"', "mode": "PERMISSIVE"}
    if corrupt:
        full = full.add(StructField(corrupt, StringType()))
        options["columnNameOfCorruptRecord"] = corrupt
    records = read_records(spark, path)
    said = F.regexp_replace("record", "^﻿", "")
    data = records.where((F.trim("record") != "") & (said != header))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    wanted = [f.name for f in schema] + ([corrupt] if corrupt and corrupt not in typed else [])
    return data.select(F.from_csv("record", ddl, options).alias("row")).select(*[F.col("row").getField(c).alias(c) for c in wanted])
