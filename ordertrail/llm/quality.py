"""Quality rules: counts that mark junk, and the distance of a document's distributions from its language.

Every language's reference is made of all its documents: the shares of character classes, and the shares of its
common words, which are those that make up at least ``COMMON_SHARE`` of its words. A document is compared with both
by the Jensen-Shannon distance (square root of the divergence to base 2, from 0 to 1), if it is long enough for its
histogram to mean anything. A language with fewer than ``OWN_WORDS`` words, which would be a reference for itself,
and documents without one are compared with a pool of all documents, in what does not depend on script or
vocabulary: character classes with all letters as one, and kinds of words.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, stored
from .arrow import Sender, arrow_schema, fields, map_batches, unused

SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
#: Character classes by the first letters of Unicode's general category; the last takes the rest.
CLASSES = ("Ll", "Lu", "L", "Nd", "P", "S", "M", "space", "")
#: A language has a reference of its own from so many words on, however large the rest is.
OWN_WORDS = 10_000
#: References of languages that hold this share of all words, so 1,000 at most, go to every task; others are joined.
LANGUAGE_SHARE = 1 / 1000
#: Words of such a language that are dealt to a task together.
LOT_WORDS = 5_000_000
#: What the character classes are in the pool: all letters and marks are one.
FOLDED = (0, 0, 0, 1, 2, 3, 0, 4, 5)
#: Common words are this share of their language's words, so there are 1,000 a language at most, of bounded size.
COMMON_SHARE, COMMON_BYTES = 1 / 1000, 32
#: Distinct words held by a task before it sends their counts on.
HELD = 200_000


@dataclass(frozen=True)
class Limits:
    """Largest distances that pass, and the number of words from which they are looked at; ``kind_distance`` is that of
    the kinds of words, which stands for the word distance in the pool.

    Both are looked at from 50 words on, under which the base counts fail a document: the class distance alone lets
    most short tables pass.
    """

    class_distance: float = 0.28
    class_words: int = 50
    word_distance: float = 0.45
    word_words: int = 50
    kind_distance: float = 0.3


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """The class of every code point."""
    kinds = {}
    table = np.empty(sys.maxunicode + 1, np.uint8)
    for point in range(sys.maxunicode + 1):
        category = unicodedata.category(chr(point))
        if category not in kinds:
            kinds[category] = next(i for i, start in enumerate(CLASSES) if category.startswith(start))
        table[point] = kinds[category]
    table[list(SPACES)] = CLASSES.index("space")
    return table


def class_counts(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.bincount(class_table()[points], minlength=len(CLASSES))


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; 1 if one is empty."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2
    terms = [np.sum(x[x > 0] * np.log2(x[x > 0] / middle[x > 0])) for x in (p, q)]
    return float(np.sqrt(min(1.0, max(0.0, sum(terms) / 2))))


def base_counts(text: str, spelled: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, and words in repeated windows of three."""
    spaces = len(spelled) - len(spelled.translate(None, SPACES))
    symbols = len(spelled) - len(spelled.translate(None, SYMBOLS))
    lines = [line for line in spelled.split(b"\n") if line.strip(SPACES)]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        times, covered = Counter(windows), -1
        for at, window in enumerate(windows):
            if times[window] > 1:
                repeated += at + 2 - max(covered, at - 1)
                covered = at + 2
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated


def word_kinds(words: Counter) -> np.ndarray:
    """Words with a letter, of the others those with a digit, and the rest."""
    out = [0, 0, 0]
    for word, n in words.items():
        said = word.decode()
        out[0 if any(map(str.isalpha, said)) else 1 if any(map(str.isdigit, said)) else 2] += n
    return np.array(out, float)


def folded(classes: np.ndarray) -> np.ndarray:
    return np.bincount(FOLDED, weights=classes)


@dataclass
class Reference:
    classes: np.ndarray
    words: dict[bytes, int]
    shares: np.ndarray  # of the common words, then of all others


@dataclass
class Pool:
    classes: np.ndarray  # folded
    kinds: np.ndarray


@dataclass
class References:
    """Of large languages, of all documents, and as a table (lang, words, counts) of the other languages, if any."""

    large: dict[str, Reference]
    pool: Pool
    others: DataFrame | None


def _tally(df: DataFrame, lang: str, text: str) -> DataFrame:
    """Rows (lang, kind, name, n): characters by class (0), all words (1), words by spelling (2) and by kind (3), added
    up by task. Documents without a language count with language null, and are not spelled."""
    ddl = "lang string, kind int, name string, n bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, words, classes, totals, kinds = Sender(schema), {}, {}, Counter(), {}
        for batch in batches:
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                said = value.as_py() or ""
                found = said.encode().lower().split()
                words.setdefault(language, Counter()).update(found)
                totals[language] += len(found)
                classes[language] = classes.get(language, 0) + class_counts(said)
            if sum(map(len, words.values())) > HELD:
                yield from send(out, words, kinds)
        yield from send(out, words, kinds)
        for language, counts in classes.items():
            for i, n in enumerate(counts.tolist()):
                out.add(language, 0, str(i), n)
            for i, n in enumerate(kinds[language].tolist()):
                out.add(language, 3, str(i), int(n))
            if out.add(language, 1, "", totals[language], size=1024):
                yield out.batch()
        yield out.batch()

    def send(out: Sender, words: dict, kinds: dict) -> Iterator[pa.RecordBatch]:
        for language, counts in words.items():
            kinds[language] = kinds.get(language, 0) + word_kinds(counts)
            if language is None:
                continue
            for word, n in counts.items():
                if len(word) <= COMMON_BYTES and out.add(language, 2, word.decode(), n, size=48):
                    yield out.batch()
        words.clear()

    return map_batches(df.select(F.col(lang).cast("string"), text), ddl, run)


def _reference(words: int, counts: list) -> Reference:
    """Of (kind, name, n) rows of one language."""
    by_class = {name: n for kind, name, n in counts if kind == 0}
    common = sorted((name, n) for kind, name, n in counts if kind == 2)
    return Reference(np.array([by_class.get(str(i), 0) for i in range(len(CLASSES))], float),
                     {name.encode(): i for i, (name, _) in enumerate(common)},
                     np.array([*(n for _, n in common), words - sum(n for _, n in common)], float))


def references(df: DataFrame, lang: str = "lang", text: str = "text") -> References:
    """References of all languages that have at least ``OWN_WORDS`` words, and the pool; over all documents.

    What comes to the driver is bounded: 1,000 languages of 1,000 common words of 32 bytes. The references of
    languages that hold less than ``LANGUAGE_SHARE`` of the words stay a written table.
    """
    tally = stored(_tally(df, lang, text).groupBy("lang", "kind", "name").agg(F.sum("n").alias("n")), "tally")
    totals = tally.where("kind = 1 and lang is not null").select("lang", F.col("n").alias("words"))
    everything = totals.agg(F.sum("words").alias("everything"))
    owning = totals.crossJoin(everything).where(F.col("words") >= OWN_WORDS).select(  # one row
        "lang", "words", (F.col("words") >= F.col("everything") * LANGUAGE_SHARE).alias("large"))

    def common(languages: DataFrame) -> DataFrame:
        return tally.join(languages, "lang").where(
            (F.col("kind") == 0) | (F.col("kind") == 2) & (F.col("n") >= F.col("words") * COMMON_SHARE))

    found: dict[str, tuple[int, list]] = {}
    for row in common(F.broadcast(owning.where("large"))).collect():  # 1,000 rows at most
        found.setdefault(row["lang"], (row["words"], []))[1].append((row["kind"], row["name"], row["n"]))
    sums = {(r["kind"], r["name"]): r["n"] for r in tally.where("kind in (0, 3)").groupBy("kind", "name").agg(
        F.sum("n").alias("n")).collect()}
    pool = Pool(folded(np.array([sums.get((0, str(i)), 0) for i in range(len(CLASSES))], float)),
                np.array([sums.get((3, str(i)), 0) for i in range(3)], float))
    others = None
    small = owning.where("not large")
    if not small.isEmpty():
        others = stored(common(small).groupBy("lang", "words").agg(
            F.collect_list(F.struct("kind", "name", "n")).alias("counts")), "references")
    return References({language: _reference(*of) for language, of in found.items()}, pool, others)


def divergences(reference: Reference, text: str, words: list[bytes], limits: Limits) -> tuple[float, float]:
    """Distances of character classes and of common words; NaN where the document is too short."""
    by_class = by_word = float("nan")
    if len(words) >= limits.class_words:
        by_class = distance(class_counts(text).astype(float), reference.classes)
    if len(words) >= limits.word_words and reference.words:
        counts = Counter(words)
        own = np.zeros(len(reference.shares))
        for word in counts.keys() & reference.words.keys():
            own[reference.words[word]] = counts[word]
        own[-1] = len(words) - own.sum()
        by_word = distance(own, reference.shares)
    return by_class, by_word


def pool_divergences(pool: Pool, text: str, words: list[bytes], limits: Limits) -> tuple[float, float]:
    """Distances of folded character classes and of the kinds of words; NaN where the document is too short."""
    by_class = by_kind = float("nan")
    if len(words) >= limits.class_words:
        by_class = distance(folded(class_counts(text)), pool.classes)
    if len(words) >= limits.word_words:
        by_kind = distance(word_kinds(Counter(words)), pool.kinds)
    return by_class, by_kind


def assess(df: DataFrame, keep: list[str], lang: str = "lang", text: str = "text", limits: Limits = Limits(),
           ) -> DataFrame:
    """``keep`` columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance and kept.

    A document fails on the base counts (under 50 words, or more than half of them in repeated windows of three),
    or for a distance beyond its limit. A distance is null, and does not speak against the document, if the text
    is too short for it or its language has no common words. Where the language is null or has fewer than
    ``OWN_WORDS`` words the distances are those from the pool, of folded classes and of kinds of words. A null text
    counts as empty: no words, not kept. One row of output per row of input; an empty table gives none. Input
    columns named like an output column are replaced.

    Only documents of languages that hold less than ``LANGUAGE_SHARE`` of the words are shuffled, by language and, of
    larger ones, by lots of ``LOT_WORDS``, if any of these has a reference: a copy of it comes first in every lot.
    """
    limit = limits
    found = references(df, lang, text)
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((found.large, found.pool))
    new = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "base_failed boolean, class_distance double, word_distance double, kept boolean")
    taken = {part.split()[0] for part in new.split(",")}
    kept = [name for name in keep if name.lower() not in taken]
    ddl = ", ".join([fields(df, *kept), new] if kept else [new])
    schema = arrow_schema(ddl)

    own_lang, own_text, own_ref, salt = (unused(kept, n) for n in ("language", "said", "reference", "salt"))
    # a text that is kept is not sent twice
    text_kept = text in kept
    lang_at, text_at = len(kept), kept.index(text) if text_kept else len(kept) + 1
    width = len(kept) + 2 - text_kept
    if text_kept:
        own_text = text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, (refs, pool) = Sender(schema), shared.value
        current: dict[str, Reference] = {}
        for batch in batches:
            # texts become strings one by one: a batch of them all would be held several times
            columns, given = batch.columns[:len(kept)], batch.column(width) if batch.num_columns > width else None
            for at, (language, text_of) in enumerate(zip(batch.column(lang_at).to_pylist(), batch.column(text_at))):
                if given is not None and given[at].is_valid:
                    own = given[at].as_py()
                    current = {language: _reference(own["words"], [tuple(c.values()) for c in own["counts"]])}
                    continue
                said = text_of.as_py() or ""
                spelled = said.encode()
                words = spelled.split()
                counts = base_counts(said, spelled, words)
                failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
                known = refs.get(language) or current.get(language)
                lowered = spelled.lower().split()
                if known:
                    far, most = divergences(known, said, lowered, limit), limit.word_distance
                else:
                    far, most = pool_divergences(pool, said, lowered, limit), limit.kind_distance
                good = not (failed or far[0] > limit.class_distance or far[1] > most)
                own_row = [column[at].as_py() for column in columns]
                size = 96 + sum(len(value) for value in own_row if isinstance(value, (str, bytes)))
                if out.add(*own_row, *counts, failed, *(None if x != x else x for x in far), good,
                           size=size):
                    yield out.batch()
        yield out.batch()

    docs = df.select(*(F.col(f"`{name}`") for name in kept), F.col(lang).cast("string").alias(own_lang), *(
        [] if text_kept else [F.col(text).alias(own_text)]))
    if found.others is None:
        return map_batches(docs, ddl, run)
    here = F.col(own_lang).isNull() | F.col(own_lang).isin(list(found.large))
    # a language is dealt out in lots of so many words, each with a copy of the reference
    lots = F.ceil(F.col("words") / LOT_WORDS).cast("int")
    refs = found.others.select(
        *(F.lit(None).cast(docs.schema[at].dataType).alias(name) for at, name in enumerate(kept)), F.col("lang").alias(own_lang),
        *([] if text_kept else [F.lit(None).cast("string").alias(own_text)]), F.struct("words", "counts").alias(own_ref),
        F.explode(F.sequence(F.lit(0), lots - 1)).alias(salt))
    none = F.lit(None).cast(refs.schema[own_ref].dataType).alias(own_ref)
    several = found.others.where(lots > 1).select(F.col("lang").alias("-lang"), lots.alias("-lots"))
    salted = docs.where(~here).join(several, F.col(own_lang) == F.col("`-lang`"), "left").select(
        *docs.columns, none, F.pmod(F.xxhash64(F.col(f"`{own_text}`")), F.coalesce("`-lots`", F.lit(1))).cast("int").alias(salt))
    beside = salted.unionByName(refs).repartition(own_lang, salt).sortWithinPartitions(
        own_lang, salt, F.col(own_ref).isNull()).drop(salt)
    return map_batches(docs.where(here), ddl, run).unionByName(map_batches(beside, ddl, run))
