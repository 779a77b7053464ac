"""Every operator with columns that are called what it calls its own, in small and capital letters."""

import public_tokenizers
import pytest

from ordertrail.llm import (
    ann, audit, bpe, decontaminate, html_tree, licenses, packing, periodic, quality, secrets, simhash)

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
INNER = ["linked", "text_key", "base", "linked_key", "__key", "__base", "__text", "__lang", "__own", "said", "language", "reference",
         "salt", "task", "number", "first", "place", "row", "words", "found", "gram", "known", "block", "ask", "part",
         "id", "v", "node", "root", "least", "same", "bits", "mask", "octave", "boundary", "numbers", "plain", "spans_", "-lang"]
TEXT = "user=bob token=abc1234 https://x.org/a " + "some words of a text that goes on " * 12


def table(spark, **types):
    """Three rows with the columns asked for and one for every inner name."""
    given = {"key": "long", "body": "string", "tongue": "string"}
    rows = [[1, TEXT, "en"], [2, None, None], [2, TEXT, "en"]]
    others = [n for n in INNER]
    schema = ", ".join([*(f"{n} {t}" for n, t in given.items()), *(f"`{n}` string" for n in others)])
    return spark.createDataFrame([(*row, *(f"{n}!" for n in others)) for row in rows], schema)


def stays(df, found):
    names = [n for n in INNER if n in found.columns]
    assert names and all(r[n] == f"{n}!" for r in found.collect() for n in names)


@pytest.fixture(scope="module")
def given(spark):
    return table(spark)


@pytest.fixture(scope="module")
def capital(given):
    return given.toDF(*[n.upper() for n in given.columns])


@pytest.mark.parametrize("run", [
    lambda df: secrets.redact(secrets.scan(df, "body", "spans"), "body", "spans"),
    lambda df: quality.assess(df, INNER, "tongue", "body"),
    lambda df: simhash.fingerprints(df, INNER, "body"),
    lambda df: html_tree.extract(df, INNER, "body", "main"),
    lambda df: licenses.matches(df, "body"),
    lambda df: decontaminate.scan(df, df.limit(1), INNER, "body", "key", "body"),
    lambda df: decontaminate.decontaminate(df, df.limit(0), text="body", item="key", bench_text="body"),
    lambda df: periodic.detect(df, INNER, "body"),
], ids=["secrets", "quality", "simhash", "html", "licenses", "decontaminate", "remove", "periodic"])
def test_columns_stay(given, capital, run):
    found = run(given)
    stays(given, found)
    assert found.count() == 3
    assert run(capital).count() == 3


KEYS = ["ids", "task", "number", "length", "piece", "start", "first", "place", "text", "fp", "component_id", "class_fp", "id",
        "node", "root", "n_words", "row", "part", "doc_id"]


@pytest.mark.parametrize("key", KEYS)
def test_keys_of_any_name(given, key):
    df = given.select(given["key"].alias(key), given["body"].alias("body" if key != "body" else "b"), "tongue")
    packed = packing.pack(df, WORDS, key=key, text="body")
    coded = bpe.encode(df, BYTES, key, "body")
    classes = simhash.near_duplicates(df, key, "body")
    for found in (packed, coded, classes):
        name = key if key in found.columns and found.columns.index(key) == 0 else f"{key}_given"
        assert found.columns[0] == name and sorted(r[0] for r in found.collect()) == [1, 2, 2]


def test_audit_and_search_by_other_names(spark, given):
    labels = spark.createDataFrame([(1, 1, 0)], "n long, quality int, toxic int")
    cells = audit.mask_cells(given.withColumnRenamed("key", "n"), labels, "n", "body", "mask")
    assert sum(r["n"] for r in cells.collect()) == 3
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], "part long, block array<double>")
    assert ann.search(vectors, vectors, key="part", vector="block").count() == 2
