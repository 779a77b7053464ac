"""CSV with line breaks in quotes: the same rows as the reader that takes one task per file, from many splits."""

import random
from decimal import Decimal

import pytest
from conftest import rows

from ordertrail.plans.catalog_sources import column_contents
from ordertrail.sources import read_csv
from ordertrail.sources.split_csv import read_records, read_split_csv
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

SCHEMA = StructType([StructField("id", IntegerType()), StructField("text", StringType()), StructField("score", IntegerType())])


def text(rng):
    return "".join(rng.choice(["a", "word ", "\n", "\n\n", '""', ",", "é", "\r\n", " "]) for _ in range(rng.randrange(30)))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path, rng, number = tmp_path_factory.mktemp("reviews"), random.Random(4), 0
    for file in range(3):
        lines = ["id,comment,text,score"]
        for _ in range(400):
            number += 1
            lines.append(f'{number},"{text(rng)}","{text(rng)}",{number % 5}')
        # one record much longer than a split
        lines.append(f'{number + 5000},x,"{"long line, " * 20}{chr(10)}{("more" + chr(10)) * 3000}",1')
        (path / f"part-{file}.csv").write_text("\n".join(lines) + "\n" * (file + 1), newline="")
    return str(path)


@pytest.fixture()
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


def test_same_rows_from_many_splits(spark, folder, small_splits):
    found = read_split_csv(spark, folder, SCHEMA)
    assert spark.read.text(folder).rdd.getNumPartitions() > 30
    wanted = read_csv(spark, folder, SCHEMA, multi_line=True)
    clean = lambda df: sorted((r[0], (r[1] or "").replace("\r\n", "\n"), r[2]) for r in df.collect())
    assert clean(found) == clean(wanted) and found.count() == 3 * 401


def test_one_split_and_broken_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,score\n1,"two\nlines",3\nx,plain,4\n2,"a ""quote"", and",\n\n3,,5', newline="")
    found = read_split_csv(spark, str(tmp_path), SCHEMA, "broken")
    assert rows(found.where("broken IS NULL"), "id", "text", "score") == [(1, "two\nlines", 3), (2, 'a "quote", and', None), (3, None, 5)]
    assert [r["broken"] for r in found.where("broken IS NOT NULL").collect()] == ["x,plain,4"]
    with pytest.raises(ValueError, match="no column other"):
        read_split_csv(spark, str(tmp_path), StructType([StructField("other", StringType())]))


def test_windows_line_ends_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id,text,score\r\n1,\"x\r\ny\",2\r\n".encode())
    assert [(r["id"], r["score"]) for r in read_split_csv(spark, str(tmp_path), SCHEMA).collect()] == [(1, 2)]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty/b.csv").write_text("")
    assert read_split_csv(spark, str(tmp_path / "empty"), SCHEMA).count() == 0


def test_lines_are_not_shuffled(spark, folder, small_splits):
    plan = read_records(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_contents_are_counted_in_short_rows(spark):
    """A cell takes part once, not in a row as wide as the table for every column; empty tables keep their lines."""
    df = spark.createDataFrame([("a", 1, Decimal("0.10")), ("a", None, Decimal("0.10")), (None, 1, None), ("", 2, Decimal("7.00"))],
                               "k string, n int, price decimal(10,2)")
    found = column_contents(df, "price")
    assert [tuple(r) for r in found.collect()] == [("k", 4, 3, 2, None), ("n", 4, 3, 2, None), ("price", 4, 3, 2, 7.2)]
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in column_contents(df.where("false"), "n").collect()] == [(c, 0, 0, 0, None) for c in df.columns]
    assert [tuple(r) for r in column_contents(df.select("n")).collect()] == [("n", 4, 3, 2, None)]
