"""Periodic runs in texts: stretches of words that repeat with some period, found tile by tile.

Periods are taken by octave, from B to 2B - 1. For each octave a document is cut into tiles of 7B words, one every 2B, so
the work per octave follows the length of the document and tiles know nothing of each other. In a tile, two Z-functions at
its boundary (one to the right, one to the left) tell how far every period of the octave reaches from there, within the
tile. These fragments are shuffled by document and period and stitched: fragments of one period that share at least a
period of words are parts of one run. Only tiles are made at whose boundary some period holds for long enough.

Why this finds everything: a run of period p has at least 4p words, so it holds a boundary with at most 2B - 1 of its words
before it and at least p + B words after it. From the first such boundary to the last, 2B words apart, the fragments reach
from the run's start to its end and overlap by 5B words, or by all they have.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .arrow import Sender, arrow_schema, fields, map_batches

#: A run has so many words at least, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: A tile in octaves: what it holds before and after its boundary, and how far boundaries are apart.
BEFORE, AFTER, APART = 2, 5, 2
#: Words on both sides of a boundary that are compared at most before a tile is made; it changes what is made, not found.
COMPARED = 24


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Words as numbers, the same for the same word."""
    numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))


def boundaries(numbers: np.ndarray, octave: int) -> list[int]:
    """Boundaries that can lie in a run of the octave, so that a tile is worth making.

    At a boundary in a run of period p, the words that equal those p further on are an octave at least to the right, and
    with those to the left as many as the run has beyond its first period. They are counted up to ``COMPARED``.
    """
    first, n = 1 << octave, len(numbers)
    stride = APART * first
    rows = -(-n // stride)
    padded = np.full(rows * stride, -1, np.int32)
    padded[:n] = numbers
    blocks = padded.reshape(rows, stride)
    # periods B..2B-1 of a boundary at 2Bi are the second half of its row
    row, period = np.nonzero(blocks[:, first:] == blocks[:, :1])
    at, period = row * stride, period + first
    needed = np.minimum(np.maximum(LEAST_WORDS, LEAST_PERIODS * period) - period, COMPARED)
    right = _matches(numbers, at, at + period, 1)
    good = right >= min(first, COMPARED)
    at, period, needed, right = at[good], period[good], needed[good], right[good]
    if len(at):
        at = at[right + _matches(numbers, at - 1, at + period - 1, -1) >= needed]
    return np.unique(at).tolist()


def _matches(numbers: np.ndarray, one: np.ndarray, other: np.ndarray, step: int) -> np.ndarray:
    """How many words from each pair of places on, in steps, are the same, counted up to ``COMPARED``."""
    count = np.zeros(len(one), np.int64)
    alive = np.arange(len(one))
    for _ in range(COMPARED):
        alive = alive[(one[alive] >= 0) & (other[alive] < len(numbers))]
        alive = alive[numbers[one[alive]] == numbers[other[alive]]]
        if not len(alive):
            break
        count[alive] += 1
        one, other = one + step, other + step
    return count


def tiles(words: list[bytes]) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(octave, start, boundary within the tile, word numbers) of the tiles of a document that are worth solving."""
    numbers = word_numbers(words)
    octave = 0
    while LEAST_PERIODS << octave <= len(numbers):
        size = 1 << octave
        for at in boundaries(numbers, octave):
            start = max(0, at - BEFORE * size)
            yield octave, start, at - start, numbers[start:at + AFTER * size]
        octave += 1


def z_function(sequence: list[int]) -> list[int]:
    """How many items from each place on equal those from the start on."""
    n = len(sequence)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and sequence[k] == sequence[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve(numbers: np.ndarray, boundary: int, octave: int) -> list[tuple[int, int, int]]:
    """(period, start, stop) within the tile of the fragments of its octave.

    A fragment holds its period for at least an octave of words after the boundary and has two periods at least; one
    whose period is a multiple of a smaller one is left to that one's octave.
    """
    size = 1 << octave
    after = numbers[boundary:].tolist()
    reach = z_function(after)  # of period q to the right: words from q on that repeat those from 0 on
    before = numbers[:boundary][::-1].tolist()
    turned = numbers[:boundary + 2 * size][::-1].tolist()
    back = z_function([*before, -1, *turned])  # -1 is no word
    shift = len(before) + 1 + len(turned) - boundary

    def stretch(q: int) -> tuple[int, int]:
        return boundary - back[shift - q] if before else boundary, boundary + q + reach[q]

    out = []
    for period in range(size, min(2 * size, len(after))):
        if reach[period] < size:
            continue
        start, stop = stretch(period)
        if stop - start < 2 * period:
            continue
        multiple = False
        for q in _parts(period):
            inner = stretch(q)
            if inner[0] <= start and inner[1] >= stop:
                multiple = True
                break
        if not multiple:
            out.append((period, start, stop))
    return out


def _parts(period: int) -> Iterator[int]:
    """``period`` divided by each of its prime factors."""
    rest, factor = period, 2
    while factor * factor <= rest:
        if rest % factor == 0:
            yield period // factor
            while rest % factor == 0:
                rest //= factor
        factor += 1
    if rest > 1:
        yield period // rest


def explode_tiles(df: DataFrame, kept: list[str], text: str) -> DataFrame:
    """Rows of two kinds. A document: ``kept`` columns, row, n, plain (SHA-256 of its words joined by a space) and, if it
    has tiles, words (so joined). A tile: row, octave, start, boundary, numbers (32-bit)."""
    new = ("row bigint, n bigint, plain string, words binary, octave int, start bigint, boundary int, numbers binary")
    ddl = f"{fields(df, *kept)}, {new}" if kept else new
    schema = arrow_schema(ddl)
    blank = [None] * len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, row = Sender(schema), TaskContext.get().partitionId() << 33
        for batch in batches:
            columns = [batch.column(i) for i in range(len(kept))]
            for at, value in enumerate(batch.column(len(kept))):
                words = (value.as_py() or "").encode().split()
                joined, some = b" ".join(words), False
                for octave, start, boundary, numbers in tiles(words):
                    some = True
                    if out.add(*blank, row, None, None, None, octave, start, boundary, numbers.tobytes(),
                               size=numbers.nbytes + 48):
                        yield out.batch()
                own = [column[at].as_py() for column in columns]
                size = 160 + len(joined) * some + sum(len(v) for v in own if isinstance(v, (str, bytes)))
                if out.add(*own, row, len(words), sha256(joined).hexdigest(), joined if some else None, None, None, None, None,
                           size=size):
                    yield out.batch()
                row += 1
        yield out.batch()

    return map_batches(df.select(*kept, F.col(text).cast("string").alias("-text")), ddl, run)


def solve_tiles(tiled: DataFrame) -> DataFrame:
    """(row, period, start, stop) of the fragments of all tiles, in words of their document. Fragments of a period that
    follow each other in a task are joined there already, so a long run leaves it as one."""
    ddl = "row bigint, period bigint, start bigint, stop bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(schema)
        document, octave_now, open_runs = None, None, {}

        def leave() -> bool:
            full = False
            for period, (start, stop) in open_runs.items():
                full |= out.add(document, period, start, stop)
            open_runs.clear()
            return full

        for batch in batches:
            for row, octave, first, boundary, numbers in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (row, octave) != (document, octave_now):
                    if leave():
                        yield out.batch()
                    document, octave_now = row, octave
                # what ends before this tile meets nothing any more
                for period in [p for p, (_, stop) in open_runs.items() if stop < first]:
                    start, stop = open_runs.pop(period)
                    if out.add(row, period, start, stop):
                        yield out.batch()
                for period, start, stop in solve(np.frombuffer(numbers, np.int32), boundary, octave):
                    start, stop = start + first, stop + first
                    if period in open_runs:
                        earlier = open_runs[period]
                        if start + period <= earlier[1]:
                            start, stop = earlier[0], max(stop, earlier[1])
                        elif out.add(row, period, *earlier):
                            yield out.batch()
                    open_runs[period] = (start, stop)
        leave()
        yield out.batch()

    return map_batches(tiled.select("row", "octave", "start", "boundary", "numbers"), ddl, run)


def stitch(fragments: DataFrame) -> DataFrame:
    """(row, start, length, period) of all runs, from fragments of any tasks: those of a document and period that share at
    least a period of words are one run. A window in the order of their starts does it, without gathering them."""
    earlier = Window.partitionBy("row", "period").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.max("stop").over(earlier)
    marked = fragments.withColumn("new", F.when(apart.isNull() | (F.col("start") + F.col("period") > apart), 1).otherwise(0))
    numbered = marked.withColumn("number", F.sum("new").over(earlier.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("row", "period", "number").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    length = F.col("stop") - F.col("start")
    return whole.where(length >= F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period"))).select(
        "row", "start", length.alias("length"), "period")


def detect(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of ``df`` (any names but the new ones, which are replaced) and n_words, runs (array of start, length,
    period by start, then period, in words counted from 0), collapsed (words without what repeats, joined by a space; null
    if that is all of them) and collapsed_sha256 (of the text that this gives, never null).

    A run is a stretch of at least ``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods whose words repeat with a smallest
    period and that no neighbouring word extends. Its words after the first period are left out of ``collapsed``; a word
    that two runs hold goes if it does in either. One row per row of ``df``; null and empty texts have no words and no
    runs; rows that repeat a text or an id are found one by one; an empty table gives no rows. Documents with tiles, about
    as many as have runs, are written to the shared folder with their words, the others without; only the former are
    joined to their runs.
    """
    kept = [name for name in keep if name not in ("n_words", "runs", "collapsed", "collapsed_sha256")]
    aside = [f"kept-{i}" for i in range(len(kept))]
    named = df.select(*(F.col(f"`{name}`").alias(other) for name, other in zip(kept, aside)), F.col(text).alias("-given"))
    tiled = stored(explode_tiles(named, aside, "-given"), "tiles")
    documents = tiled.where("n is not null").select(*aside, "row", "n", "plain", "words")
    runs = stitch(solve_tiles(tiled.where("octave is not null"))).groupBy(F.col("row").alias("of")).agg(
        F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    found = documents.where("words is not null").join(runs, F.col("row") == F.col("of"), "left")
    ddl = ", ".join([*([fields(named, *aside)] if aside else []), "n_words bigint",
                     "runs array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed string", "collapsed_sha256 string"])
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    collapsed = _collapse(found.select(*aside, "n", "plain", "words", F.coalesce("runs", none).alias("runs")), aside, ddl)
    others = documents.where("words is null").select(
        *aside, F.col("n").alias("n_words"), none.alias("runs"), F.lit(None).cast("string").alias("collapsed"),
        F.col("plain").alias("collapsed_sha256"))
    return collapsed.unionByName(others).select(
        *(F.col(other).alias(name) for name, other in zip(kept, aside)), "n_words", "runs", "collapsed", "collapsed_sha256")


def _collapse(df: DataFrame, kept: list[str], ddl: str) -> DataFrame:
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(schema)
        for batch in batches:
            *columns, ns, plains, texts, runs = [batch.column(i) for i in range(len(kept) + 4)]
            for at, (n, plain, said, found) in enumerate(zip(ns.to_pylist(), plains.to_pylist(), texts, runs)):
                left = None
                spans = found.as_py()
                if spans:
                    words = np.array(said.as_py().split(), object)
                    stays = np.ones(n, bool)
                    for span in spans:
                        stays[span["start"] + span["period"]:span["start"] + span["length"]] = False
                    left = b" ".join(words[stays])
                    plain = sha256(left).hexdigest()
                own = [column[at].as_py() for column in columns]
                size = 160 + len(left or b"") + 24 * len(spans) + sum(len(v) for v in own if isinstance(v, (str, bytes)))
                if out.add(*own, n, spans, None if left is None else left.decode(), plain, size=size):
                    yield out.batch()
        yield out.batch()

    return map_batches(df, ddl, run)
