"""Counts and distances against a plain version."""

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest

from ordertrail.llm import quality
from ordertrail.llm.queries import op4_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def histogram(text):
    out = Counter()
    for c in text:
        kind = unicodedata.category(c)
        out["space" if c in " \t\n\v\f\r" else next(k for k in quality.CLASSES if kind.startswith(k))] += 1
    return np.array([out[k] for k in quality.CLASSES], float)


def js(p, q):
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    return math.sqrt(max(0, sum(x * math.log2(x / c) for a in (p, q) for x, c in zip(a, m) if x > 0) / 2))


@pytest.mark.parametrize("text", [
    "", " \n\t", "a b c a b c a b c", "x x x x x", "line\nline\n \n \nline", "é b\x1cc # * $", "one two three one two", "a" * 10000])
def test_base_counts(text):
    spelled = text.encode()
    assert quality.base_counts(text, spelled, spelled.split()) == plain(text)


def test_distance():
    a, b = np.array([1.0, 0, 3]), np.array([0, 2.0, 0])
    assert quality.distance(a, a) == 0 and quality.distance(a, b) == pytest.approx(1)
    assert quality.distance(a, np.zeros(3)) == 1
    assert quality.distance(a, a + b) == pytest.approx(js(a, a + b))


def test_query(spark, folder):
    docs = {r["doc_id"]: (r["text"] or "", r["lang"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in op4_quality_rules(spark, folder).collect()}
    assert set(rows) == set(docs)
    limits = quality.Limits()
    classes, words = {}, {}
    for text, lang in docs.values():
        classes[lang] = classes.get(lang, 0) + histogram(text)
        words.setdefault(lang, Counter()).update(text.encode().lower().split())
    common = {}
    for lang, counts in words.items():
        total = sum(counts.values())
        chosen = {w: n for w, n in counts.items() if n * 1000 >= total and len(w) <= quality.COMMON_BYTES}
        common[lang] = (list(chosen), np.array([*chosen.values(), total - sum(chosen.values())], float))
    for doc_id, (text, lang) in docs.items():
        r, counts = rows[doc_id], plain(text)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert r["base_failed"] == failed
        far = False
        if counts[0] >= limits.class_words:
            by_class = js(histogram(text), classes[lang])
            assert r["class_distance"] == pytest.approx(by_class, abs=1e-9)
            far |= by_class > limits.class_distance
        if counts[0] >= limits.word_words:
            own = Counter(text.encode().lower().split())
            found = [own[w] for w in common[lang][0]]
            by_word = js(np.array([*found, counts[0] - sum(found)], float), common[lang][1])
            assert r["word_distance"] == pytest.approx(by_word, abs=1e-9)
            far |= by_word > limits.word_distance
        else:
            assert r["word_distance"] is None
        assert r["kept"] == (not failed and not far)


def test_good_documents_stay_and_junk_goes(spark, folder):
    kept = {r["doc_id"]: r["kept"] for r in op4_quality_rules(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    good = [kept[r["doc_id"]] for r in labels if r["quality"] == 1]
    bad = [kept[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert sum(good) / len(good) > 0.9 and sum(bad) / len(bad) < 0.5


def test_junk_goes_at_every_length(spark, folder):
    rows = {r["doc_id"]: r for r in op4_quality_rules(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    seen = 0
    for least, most in [(50, 99), (100, 199), (200, 1 << 30)]:
        band = [(r["quality"], rows[r["doc_id"]]) for r in labels if least <= rows[r["doc_id"]]["n_words"] <= most]
        good = [r["kept"] for quality_label, r in band if quality_label == 1]
        bad = [r["kept"] for quality_label, r in band if quality_label == 0 and not r["base_failed"]]
        assert good and sum(good) / len(good) > 0.95, (least, most)
        assert sum(bad) <= 0.1 * len(bad), (least, most)
        seen += len(bad)
    assert seen


def test_rows(spark):
    prose = " ".join(f"word{i % 70} and the {i}" for i in range(100))
    junk = " ".join(f"## {i} ||" for i in range(100))
    rows = [(1, None, "en", 1.0), (1, "", "en", 2.0), (None, prose, None, 3.0), (2, prose, "en", 4.0), (2, prose, "en", 4.0),
            (3, prose, "xx" * 50, 5.0), (4, junk, "en", 6.0)]
    rows += [(10 + i, prose, "en", 0.0) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept double")
    found = quality.assess(df, ["doc_id", "kept", "lang"])
    assert found.columns[:2] == ["doc_id", "lang"] and found.count() == len(rows)
    verdict = {(r["doc_id"], r["lang"]): r["kept"] for r in found.collect()}
    assert verdict[(2, "en")] and verdict[(None, None)] and not verdict[(1, "en")] and not verdict[(4, "en")]
    assert quality.assess(df.limit(0), ["doc_id"]).count() == 0


def _documents(spark, folder):
    return [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def _verdicts(spark, rows):
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string").repartition(3)
    found = quality.assess(df, ["doc_id", "lang"]).collect()
    assert sorted((r["doc_id"], r["lang"]) for r in found if r["doc_id"]) == sorted((r[0], r[2]) for r in rows if r[0])
    assert len(found) == len(rows)
    return {r["doc_id"]: r for r in found}


def test_small_languages(spark, folder, monkeypatch):
    """Documents under rare labels: one with words enough for a reference, and one, or none, without."""
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    docs = _documents(spark, folder)
    rows = [(str(i), text, lang) for i, text, lang in docs]
    moved = [(i, text) for i, text, lang in docs if lang == "de"]
    some = [(i, text) for i, text, lang in docs if labels.get(i) is not None and len((text or "").split()) >= 50]
    some = [x for x in some if labels[x[0]] == 1][:5] + [x for x in some if labels[x[0]] == 0]
    rows += [(f"rare{i}", text, "aa") for i, text in moved]
    rows += [(f"few{i}", text, f"b{i}") for i, text in some] + [(f"none{i}", text, None) for i, text in some]
    usual = _verdicts(spark, rows)
    monkeypatch.setattr(quality, "LANGUAGE_SHARE", 0.9)  # no language is large: each reference is joined
    joined = _verdicts(spark, rows)
    assert {k: r["kept"] for k, r in joined.items()} == {k: r["kept"] for k, r in usual.items()}
    for i, text in moved:
        a, b = joined[f"rare{i}"], joined[str(i)]
        assert (a["class_distance"], a["word_distance"], a["kept"]) == (b["class_distance"], b["word_distance"], b["kept"])
    for start in ("few", "none"):
        verdicts = [(labels[i], joined[f"{start}{i}"]["kept"]) for i, _ in some]
        assert all(kept for good, kept in verdicts if good) and not any(kept for good, kept in verdicts if not good)


def test_a_verdict_does_not_depend_on_other_languages(spark, folder):
    docs = _documents(spark, folder)
    one = [(str(i), text, lang) for i, text, lang in docs if lang == "es"]
    size = sum(len((text or "").split()) for _, text, _ in one)
    alone = _verdicts(spark, one)
    other = spark.range(1100, numPartitions=8).selectExpr(
        "concat('x', id) as doc_id", f"repeat('w ', {size}) as text", "'zz' as lang")
    beside = quality.assess(spark.createDataFrame(one, other.schema).unionByName(other), ["doc_id"])
    beside = {r["doc_id"]: r for r in beside.where("doc_id not like 'x%'").collect()}
    for doc_id, r in alone.items():
        assert beside[doc_id]["word_distance"] == r["word_distance"] and beside[doc_id]["kept"] == r["kept"]


def test_letters_of_a_script_do_not_count_against_a_small_language(spark, folder):
    rows = [(str(i), text, lang) for i, text, lang in _documents(spark, folder)]
    arabic = "".join(chr(0x628 + j % 19) for j in range(40))
    prose = " ".join(arabic[j % 31:j % 31 + 2 + j % 7] + ("." if j % 12 == 11 else "") for j in range(120))
    rows += [("arabic", prose, "ar"), ("table", " | ".join(arabic[j % 31:j % 31 + 2 + j % 7] for j in range(60)), "ar")]
    found = _verdicts(spark, rows)
    assert found["arabic"]["kept"] and not found["table"]["kept"]
