"""Fingerprints, trees, components and the whole operator against brute force."""

import re

import numpy as np
import pytest
import xxhash

from ordertrail.llm import simhash
from ordertrail.llm.queries import op5_simhash_near_dedup


def plain_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) > n else \
        [" ".join(words)] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def components_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_pairs(fps, distance=4):
    fps = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= distance):
            yield i, i + 1 + int(j)


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c d", "a b c d e", "É e E x\xa0y z w", "the same " * 200, "x " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def fingerprints(seed, random, near, flips):
    rng = np.random.default_rng(seed)
    fps = rng.integers(0, 2 ** 63, random + near, dtype=np.uint64) * np.uint64(2)
    fps[:near] = fps[0]
    for i in range(near):
        for bit in rng.choice(64, rng.integers(0, flips + 1), replace=False):
            fps[i] ^= np.uint64(1) << np.uint64(bit)
    return np.unique(fps)


@pytest.mark.parametrize("count, random, near, flips", [(1, 2000, 300, 6), (3, 8000, 1500, 8), (5, 3000, 1000, 4), (3, 10, 6000, 3)])
def test_forest_finds_all(count, random, near, flips):
    fps = fingerprints(count, random, near, flips)
    edges = []
    for tree in simhash.forest(fps[::3], len(fps), 4, count):
        for _, members in tree.route(fps):
            for others, least in simhash.stars(members, 4):
                edges += [(int(least), int(o)) for o in others]
    signed = fps.view(np.int64).tolist()
    found = components_of(edges, signed)
    expected = components_of(((signed[i], signed[j]) for i, j in near_pairs(fps)), signed)
    classes = lambda of: {frozenset(n for n in of if of[n] == r) for r in set(of.values())}
    if len(fps) < 4000:
        assert classes(found) == classes(expected)
    assert sorted(found.values()) == sorted(expected.values())


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 400)] + [(1000, i) for i in range(1001, 1300)] + [(7, 7), (2000, 2001), (2001, 2000)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    expected = components_of(chain, {n for e in chain if e[0] != e[1] for n in e})
    assert found == expected
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows(spark):
    said = "the quick brown fox jumps over the lazy dog and runs far away from here " * 20
    rows = [(5, said, "x", 1), (3, said.upper(), "x", 1), (9, None, "x", 1), (8, "", "x", 1), (None, said, "x", 1), (5, said, "x", 1),
            (20, "quite another text with words of its own that nobody wrote before", "x", 1), (None, "nobody's words", "x", 1),
            (30, "y " * 100_000, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(rows)
    of = {}
    for r in found:
        of.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert of == {5: {3}, 3: {3}, 9: {8}, 8: {8}, None: {3, None}, 20: {20}, 30: {30}}
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_query(spark, folder):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in op5_simhash_near_dedup(spark, folder).collect()}
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    assert [rows[i]["fingerprint"] for i in ids] == [f"{f:016x}" for f in fps]
    expected = components_of(((ids[i], ids[j]) for i, j in near_pairs(fps)), ids)
    assert {i: rows[i]["component_id"] for i in ids} == expected
    assert len(set(expected.values())) < len(ids)
