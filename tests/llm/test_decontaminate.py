"""Benchmark passages against a plain search of all windows."""

import random
import re

from ordertrail.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(text, bench, size=10):
    """(words, hit words, names of items) by comparing every window of the text with every window of every item."""
    own, hit, names = words(text), set(), set()
    for item, said in bench:
        given = words(said)
        length = min(size, len(given))
        if not length:
            continue
        wanted = {tuple(given[i:i + length]) for i in range(len(given) - length + 1)}
        for at in range(len(own) - length + 1):
            if tuple(own[at:at + length]) in wanted:
                hit |= set(range(at, at + length))
                if item is not None:
                    names.add(str(item))
    return len(own), sorted(hit), sorted(names)


PASSAGE = "Alpha beta GAMMA, delta; epsilon zeta-eta theta iota kappa lambda mu nu."
BENCH = [(7, PASSAGE), (30, "lone"), (30, "lone"), (4, "Two words"), (None, "no name here"), (5, None), (6, " .,; "),
         (8, "İstanbul É é ÀB naïve"), (9, PASSAGE[:60] + " other end of the passage it is")]
TEXTS = [
    None, "", " \n.,", PASSAGE, f"before it {PASSAGE} after", PASSAGE[6:], PASSAGE.replace("GAMMA", "gama"), PASSAGE * 3,
    "alpha beta gamma delta epsilon zeta eta theta iota\nkappa", "alpha beta gamma delta epsilon zeta eta theta iota",
    "one LONE word", "two words two words", "x two, WORDS!", "no name here", "istanbul é é Àb naïve", "İstanbul É é Àb naïve",
    "lone " * 5000, "clean text " * 9000, "ALONE", "lone",
]


def found(spark, texts, bench, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(bench, "item_id long, text string")
    rows = decontaminate.scan(docs, items, ["doc_id"], **how).collect()
    return {r["doc_id"]: (r["n_words"], [i for s in r["spans"] for i in range(s["at"], s["stop"])], list(r["items"])) for r in rows}


def test_equals_a_plain_search(spark):
    expected = {i: plain(t, BENCH) for i, t in enumerate(TEXTS)}
    assert found(spark, TEXTS, BENCH) == expected
    # beyond the size that is sent along, the join is Spark's to choose
    assert found(spark, TEXTS, BENCH, sent_bytes=0) == expected


def test_random_texts(spark):
    rng = random.Random(5)
    vocabulary = ["a", "B", "c3", "é", "d"]

    def some(most):
        return " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(most)))

    bench = [(i, some(9)) for i in range(12)]
    texts = [some(60) for _ in range(80)]
    assert found(spark, texts, bench, size=4) == {i: plain(t, bench, 4) for i, t in enumerate(texts)}


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    """A bitmap that lets everything through only leaves more to verify."""
    monkeypatch.setattr(decontaminate, "BITS_LEAST", 64)
    monkeypatch.setattr(decontaminate, "BITS_MOST", 64)
    bench = BENCH + [(100 + i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(60)]
    assert found(spark, TEXTS, bench) == {i: plain(t, bench) for i, t in enumerate(TEXTS)}


def test_empty_tables_copies_and_names(spark):
    docs = spark.createDataFrame(
        [(1, "lone x", 5, "s", "r"), (1, "lone x", 5, "s", "r"), (None, "x", 6, None, None)],
        "n_hit long, text string, words long, kept string, row string")
    items = spark.createDataFrame([(1, "lone")], "item_id long, text string")
    rows = decontaminate.scan(docs, items, ["words", "kept", "row", "n_hit"]).collect()
    assert sorted((r["words"], r["kept"], r["row"], r["n_hit"]) for r in rows if r["kept"]) == [(5, "s", "r", 1)] * 2
    assert len(rows) == 3
    cut = decontaminate.decontaminate(docs, items)
    assert cut.columns == docs.columns
    assert sorted(map(tuple, cut.collect()), key=repr) == sorted(
        [(1, " x", 5, "s", "r")] * 2 + [(None, "x", 6, None, None)], key=repr)
    assert decontaminate.decontaminate(docs, items, "documents").count() == 1
    assert decontaminate.decontaminate(docs, items, "documents", share=0.5).count() == 3
    nothing = items.where("false")
    assert [r["n_hit"] for r in decontaminate.scan(docs, nothing, []).collect()] == [0, 0, 0]
    assert decontaminate.scan(docs.where("false"), items, ["text"]).count() == 0


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(f"Before it: {PASSAGE} After!",), ("lone",), (None,), ("Clean. ",)], "text string")
    items = spark.createDataFrame([(1, PASSAGE), (2, "lone")], "item_id long, text string")
    left = [r["text"] for r in decontaminate.decontaminate(docs, items).collect()]
    assert sorted(left, key=repr) == sorted(["Before it After!".replace("it After", "it. After"), "", None, "Clean. "], key=repr)


def test_no_python_and_no_texts_in_the_shuffle(spark, folder):
    docs, items = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    plan = decontaminate.scan(docs, items, ["doc_id"], sent_bytes=0)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert not re.search(r"\bwords#", plan)
