"""The operators that SQL can express, against DuckDB on the same tables."""

import os

import duckdb
import pytest

from ordertrail.llm.queries import ORACLES, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_and_types(spark, folder, name):
    duck = duckdb.connect()
    for file in os.listdir(folder):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    cursor = duck.execute(ORACLES[name])
    position = {d[0]: i for i, d in enumerate(cursor.description)}
    df = QUERIES[name](spark, folder)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == {d[0]: str(d[1]) for d in cursor.description}
    expected = sorted((tuple(row[position[c]] for c in df.columns) for row in cursor.fetchall()), key=repr)
    assert sorted(map(tuple, df.collect()), key=repr) == expected
    assert expected
