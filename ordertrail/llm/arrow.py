"""Helpers for functions that run on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..session import ship_package

#: Rows of output are sent in batches of about this many bytes.
BATCH_BYTES = 8_000_000


class Sender:
    """Collects columns of output rows and cuts them into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self._start()

    def _start(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.bytes = 0

    def add(self, *values, size: int = 64) -> bool:
        """Add a row of about ``size`` bytes; True if the batch should be sent now."""
        for column, value in zip(self.columns, values):
            column.append(value)
        self.bytes += size
        return self.bytes >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(column, field.type) for column, field in zip(self.columns, self.schema)]
        self._start()
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def unused(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores behind it as long as it is one of ``taken``; Spark's names ignore case."""
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name += "_"
    return name


def given_name(key: str, new: Iterable[str]) -> str:
    """What a key column is called in the result: its name, or ``<name>_given`` if a new column has it."""
    return f"{key}_given" if key.lower() in {n.lower() for n in new} else key


def fields(df: DataFrame, *names: str) -> str:
    """Columns of ``df`` with their types, as part of a schema string."""
    kinds = {f.name.lower(): f.dataType.simpleString() for f in df.schema}
    return ", ".join(f"`{name}` {kinds[name.lower()]}" for name in names)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a Spark schema string."""
    return to_arrow_schema(_parse_datatype_string(ddl))


def map_batches(df: DataFrame, ddl: str, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                ) -> DataFrame:
    """``mapInArrow`` with this package available on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, ddl)
