"""The filter audit against applying the filters one after the other."""

import re
from collections import Counter
from itertools import permutations

import pytest

from ordertrail.llm import audit


def fails(rows):
    """The letters that every row (id, text, part) fails."""
    first = {}
    for key, text, _ in rows:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    out = []
    for key, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        tests = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": key is not None and first[text] < key}
        out.append({letter for letter, failed in tests.items() if failed})
    return out


def plain(rows, labels):
    """All counts by removing documents in every order."""
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    failed = fails(rows)
    out, shapley = {}, Counter()
    for part in {p or "" for _, _, p in rows}:
        own = [(key, f) for (key, _, p), f in zip(rows, failed) if (p or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                hit = [key for key, f in left if letter in f]
                redundant = sum(letter in f for _, f in own) - len(hit)
                left = [(key, f) for key, f in left if letter not in f]
                out[part, "".join(order), step] = (
                    len(left), len(hit), redundant, sum(f == {letter} for _, f in own), sum(k in good for k in hit),
                    sum(k in toxic for k in hit))
                shapley[part, letter] += len(hit)
    return {(part, order, step): (*counts, shapley[part, order[step - 1]]) for (part, order, step), counts in out.items()}


LONG = " ".join(f"w{i}" for i in range(220))
ROWS = [
    (1, LONG, "en"), (2, LONG, "de"), (2, LONG, "de"), (3, LONG, "en"), (None, LONG, "en"), (None, LONG, None),
    (4, None, "en"), (5, "", None), (6, "", "fr"), (7, "A B C # d", "en"), (8, "same " * 300, "en"),
    (9, "same " * 300 + "|", "fr"), (10, LONG + " %", "fr"), (11, LONG.upper(), "en"), (12, LONG.upper() + "*", ""),
    (0, LONG.upper(), "it"), (13, "é" * 300 + "AB" * 4, "it"), (14, " x y " * 120, "it"), (3, LONG, "en"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (3, 1, None), (8, None, 1), (9, 1, 0), (7, 0, 0), (11, 1, 1), (None, 1, 1), (99, 1, 1)]


def run(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.interactions(audit.mask_cells(docs, given)).collect()
    assert len({tuple(r)[:3] for r in found}) == len(found)
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in found}


def test_equals_filtering_in_every_order(spark):
    assert run(spark, ROWS, LABELS) == plain(ROWS, LABELS)


def test_empty_tables(spark):
    assert run(spark, ROWS[:1], []) == plain(ROWS[:1], [])
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert audit.interactions(audit.mask_cells(docs, labels)).count() == 0


def test_other_names_and_clashes(spark):
    docs = spark.createDataFrame([(k, t, p, 0, "x", 1) for k, t, p in ROWS],
                                 "id long, body string, bits string, n int, same string, key int")
    labels = spark.createDataFrame(LABELS, "id long, quality int, toxic int")
    found = audit.interactions(audit.mask_cells(docs, labels, "id", "body", "bits")).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found} == plain(ROWS, LABELS)


def test_prefixes_are_all_and_few(spark):
    rows = audit.prefixes(spark, "AB").collect()
    assert sorted((r["prefix"], r["before"], r["bit"]) for r in rows if r["mask"] == 3) == [
        ("A", 0, 1), ("AB", 1, 2), ("B", 0, 2), ("BA", 2, 1)]
    assert audit.prefixes(spark).count() == 32 * 325
    with pytest.raises(ValueError):
        audit.interactions(None, "AA")
