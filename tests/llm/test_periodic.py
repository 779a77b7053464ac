"""Periodic runs against a search of every period at every word."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

from ordertrail.llm import periodic
from ordertrail.llm.queries import op12_periodic_runs


def split(text):
    return (text or "").encode().split()


def plain(words):
    """(start, length, period) of all runs: all stretches of all periods, each with its smallest period."""
    n, found = len(words), {}
    numbers = periodic.word_numbers(words)
    for period in range(1, n // 4 + 1):
        same = np.concatenate(([False], numbers[period:] == numbers[:-period], [False]))
        edges = np.flatnonzero(np.diff(same.astype(np.int8)))
        for start, stop in zip(edges[::2], edges[1::2]):
            length = int(stop - start) + period
            if length >= max(6, 4 * period):
                found.setdefault((int(start), length), period)  # the smallest comes first
    return sorted((start, length, period) for (start, length), period in found.items())


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    rng = random.Random(11)
    out = [None, "", " \n ", "a", "a a a a a", "a a a a a a", "x a a a a a a y", "a b a b a b a b", "a b a b a b a", "é é é é é é \x0b é",
           "a " * 3000, "a b c " * 700 + "d", "x " * 40 + "y " * 40, "a b a b a b a b c a b a b a b a b", "a a b " * 9 + "a a",
           "a b c d e f g h i j " * 4, " ".join(str(i) for i in range(3000)), "a a a a a a b a a a a a a " * 5]
    for _ in range(150):
        words = [rng.choice("ab" if rng.random() < .5 else "abcde") for _ in range(rng.randrange(1, 90))]
        for _ in range(rng.randrange(4)):
            block, at = [rng.choice("abcd") for _ in range(rng.randrange(1, 30))], rng.randrange(len(words) + 1)
            words[at:at] = (block * 9)[:rng.randrange(3 * len(block), 8 * len(block))]
        out.append(" ".join(words))
    for period in (7, 8, 9, 15, 16, 17, 63, 64, 65, 127, 200):
        block = [str(rng.randrange(10 ** 6)) for _ in range(period)]
        for lead in (0, 1, period - 1, rng.randrange(500)):
            head = [str(rng.randrange(10 ** 6)) for _ in range(lead)]
            out.append(" ".join(head + (block * 9)[:4 * period + rng.randrange(4 * period)] + head))
            out.append(" ".join(head + (block * 9)[:4 * period] + ["end"]))
            out.append(" ".join(head + (block * 9)[:4 * period - 1] + ["end"]))
    return out


def detected(df, **how):
    return {r["id"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"], r["collapsed_sha256"])
            for r in periodic.detect(df, ["id"], **how).collect()}


def expected(given):
    out = {}
    for i, text in given:
        words = split(text)
        runs = plain(words)
        left = collapsed(words, runs)
        out[i] = (len(words), runs, left.decode() if runs else None, sha256(left).hexdigest())
    return out


def test_equals_a_search_of_every_period(spark):
    given = list(enumerate(texts()))
    assert detected(spark.createDataFrame(given, "id long, text string").repartition(4)) == expected(given)


def test_tiles_in_any_tasks(spark):
    """Stitching does not depend on what a task sees: every tile alone, in any order."""
    given = [(i, t) for i, t in enumerate(texts()) if t and len(t) < 2000]
    for i, text in given[::5]:
        fragments = [(i, p, s + first, e + first) for octave, first, boundary, numbers in periodic.tiles(split(text))
                     for p, s, e in periodic.solve(numbers, boundary, octave)]
        random.Random(i).shuffle(fragments)
        if i % 10 == 0:
            df = spark.createDataFrame(fragments, "row long, period long, start long, stop long").repartition(5)
            found = sorted((r["start"], r["length"], r["period"]) for r in periodic.stitch(df).collect())
            assert found == plain(split(text)), text


@pytest.mark.parametrize("compared", [1, 5])
def test_what_is_compared_first_changes_nothing(monkeypatch, compared):
    monkeypatch.setattr(periodic, "COMPARED", compared)
    for text in texts()[5:60]:
        words, best = split(text), {}
        for octave, first, boundary, numbers in periodic.tiles(words):
            for p, s, e in periodic.solve(numbers, boundary, octave):
                if e - s >= max(6, 4 * p):
                    best[p] = max(best.get(p, 0), e - s)
        assert set(p for _, _, p in plain(words)) >= set(best)


def test_few_tiles_without_runs():
    rng = random.Random(3)
    words = [str(int(rng.paretovariate(0.3))).encode() for _ in range(20_000)]
    assert sum(1 for _ in periodic.tiles(words)) < 40


def test_a_long_run_leaves_a_task_as_one(spark):
    df = spark.createDataFrame([(1, "a " * 20_000)], "id long, text string")
    tiled = periodic.explode_tiles(df, ["id"], "text")
    assert [tuple(r)[1:] for r in periodic.solve_tiles(tiled.where("octave is not null").coalesce(1)).collect()] == [(1, 0, 20_000)]


def test_names_copies_and_empty_tables(spark):
    rows = [(None, "a " * 8, "k", 1), (None, "a " * 8, "k", 1), (1, None, None, 2)]
    df = spark.createDataFrame(rows, "n_words long, text string, words string, `row` int")
    found = periodic.detect(df, ["words", "row", "n_words", "text"])
    assert sorted(map(repr, ((r["words"], r["row"], r["n_words"], r["text"], len(r["runs"])) for r in found.collect()))) == sorted(
        map(repr, [("k", 1, 8, "a " * 8, 1)] * 2 + [(None, 2, 0, None, 0)]))
    assert periodic.detect(df.where("false"), []).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    wanted = {}
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        words = split(doc["text"])
        h, n = zlib.crc32(str(doc["doc_id"]).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = plain(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        wanted[doc["doc_id"]] = (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
            sha256(collapsed(words, runs)).hexdigest())
    found = op12_periodic_runs(spark, folder)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in found.dtypes} == {"bigint", "string"}
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == wanted
    assert sum(r[0] for r in wanted.values()) > 5
