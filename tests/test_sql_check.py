"""Every registered query that SQL can express, against DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from ordertrail.plans import oracles, registered

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracles()))
def test_same_rows_and_types(spark, duck, folder, name):
    df = registered()[name](spark, folder)
    cursor = duck.execute(oracles()[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    columns = sorted(df.columns)
    assert columns == sorted(types)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    position = [d[0] for d in cursor.description]
    expected = sorted((tuple(r[position.index(c)] for c in columns) for r in cursor.fetchall()), key=repr)
    found = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert found == expected
    assert found, "a check without rows checks nothing"


def test_entry(spark):
    assert entry_module.entry(spark).count() == 6
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
