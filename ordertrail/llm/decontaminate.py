"""Benchmark passages in training texts, found and removed with DataFrame functions only.

A window is ``size`` consecutive words of a benchmark item; a shorter item is one window. Documents are scanned once:
the hash of every window of words is looked up in a bitmap of the benchmark's window hashes, which goes to every task
and whose size is bounded whatever the benchmark's. Before a window is put together, the hash of four of its words is looked
up in the same bitmap, which is several times cheaper and stops most windows. What the bitmap lets through, few windows beside the real ones, leaves the
scan as text and is verified by a join with the benchmark's windows. Texts never move.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

SIZE = 10
#: Between words, once A-Z are lower-cased; and the same in a text as it is.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GIVEN_BETWEEN, _GIVEN_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bits of the bitmap: so many for a window, at least and at most so many in all. Two bits are set for each of a window's
#: two keys, so of other keys (4 / 64) ** 2 pass by chance while the most is not reached; beyond it more do, and are verified.
BITS_EACH, BITS_LEAST, BITS_MOST = 64, 1 << 12, 1 << 24
#: Windows go to every task for the verification if their texts and item ids take so many bytes; else Spark decides.
SENT_BYTES = 32_000_000
_BUCKET = 4096  # bytes of Spark's bitmap aggregate
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """Words of a text: what lies between ASCII characters that are no letters or digits, A-Z in lower case."""
    said = F.coalesce(text, F.lit(""))
    # lower() is the faster one and does the same to ASCII
    lowered = F.when(F.octet_length(said) == F.length(said), F.lower(said)).otherwise(F.translate(said, UPPER, LOWER))
    return F.filter(F.split(lowered, BETWEEN, -1), lambda w: w != "")


def _window(words: Column, at: Column, size: int) -> Column:
    return F.slice(words, at, F.lit(size))


def _outline(words: Column, before: Column, length) -> Column:
    """Hash of four words of the window of ``length`` words after the first ``before``: first, last, and two between."""
    places = [F.floor(k * (length - 1) / 3) if isinstance(length, Column) else F.lit(k * (length - 1) // 3) for k in range(4)]
    return F.xxhash64(*(F.element_at(words, (before + place + 1).cast("int")) for place in places))


def windows(bench: DataFrame, item: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """The different windows of all items: gram (words joined by a space), length, keys (hash of four words, and of all) and
    items (sorted ids).

    Items without words have none. A null id is in no list, but its windows count.
    """
    given = bench.select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    length = F.least(F.size("words"), F.lit(size))
    cut = given.where(F.size("words") > 0).select("item", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - length + 1), lambda i: F.slice("words", i, length))).alias("window"))
    return cut.groupBy(F.array_join("window", " ").alias("gram")).agg(
        F.first(F.size("window")).alias("length"), F.first(F.array(
            _outline(F.col("window"), F.lit(0), F.size("window")), F.xxhash64("window"))).alias("keys"),
        F.array_sort(F.collect_set("item")).alias("items"))


def _places(key: Column, bits: int) -> list[Column]:
    """The two places of a window's hash in a bitmap: its lower and its upper half."""
    return [key.bitwiseAND(F.lit(bits - 1)), F.shiftright(key, 32).bitwiseAND(F.lit(bits - 1))]


def bitmap(grams: DataFrame, count: int) -> tuple[int, list[int]]:
    """Number of bits (a power of two, at most ``BITS_MOST``) and the 64-bit words of the bitmap of all window hashes.

    Spark's bitmap aggregate packs the bits; at most ``BITS_MOST`` / 32,768 rows of 4 KB come to the driver.
    """
    bits = BITS_LEAST
    while bits < min(BITS_EACH * count, BITS_MOST):
        bits *= 2
    # the aggregate's buckets count from 1
    keys = grams.select(F.explode("keys").alias("key"))
    placed = keys.select(F.explode(F.array(*_places(F.col("key"), bits))).alias("at")).select((F.col("at") + 1).alias("at"))
    packed = placed.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("packed")).collect()
    whole = bytearray(max(bits // 8, _BUCKET))
    for row in packed:
        whole[(row["bucket"] - 1) * _BUCKET:row["bucket"] * _BUCKET] = row["packed"]
    return bits, np.frombuffer(whole, "<i8")[:bits // 64].tolist()


def _candidates(words: Column, lengths: list[int], bits: int, packed: list[int]) -> Column:
    """Array of (at, length, gram) of the windows of a text that the bitmap lets through; ``at`` counts from 0."""
    # written as text and cast, the bitmap is one literal of the plan
    literal = F.split(F.lit(",".join(map(str, packed))), ",").cast("array<bigint>")

    def known(given: Column, key: Column) -> Column:
        tests = [F.getbit(F.element_at(given["bitmap"], (F.shiftright(at, 6) + 1).cast("int")),
                          at.bitwiseAND(F.lit(63)).cast("int")) == 1 for at in _places(key, bits)]
        return tests[0] & tests[1]

    def search(given: Column) -> Column:
        found = []
        for size in lengths:
            last = F.size(given["words"]) - size
            # a text that is too short has no windows; a sequence down to 0 would be one
            starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
            # a key is used several times, so it is computed first
            outlined = F.transform(starts, lambda i: _outline(given["words"], i, size))
            likely = F.array_compact(F.transform(outlined, lambda key, i: F.when(known(given, key), i)))
            cut = F.transform(likely, lambda i: F.struct(i.alias("at"), _window(given["words"], i + 1, size).alias("window")))
            let_through = F.filter(cut, lambda c: known(given, F.xxhash64(c["window"])))
            found.append(F.transform(let_through, lambda c: F.struct(
                c["at"], F.lit(size).alias("length"), F.array_join(c["window"], " ").alias("gram"))))
        return F.concat(*found)

    return _bound(F.struct(words.alias("words"), literal.alias("bitmap")), search)


def _covered(spans: Column) -> Column:
    """Disjoint (at, stop) from windows (at, length), in order."""
    none = F.array().cast("array<struct<at:int,stop:int>>")
    return F.aggregate(
        F.array_sort(spans), F.struct(none.alias("out"), F.lit(-1).alias("at"), F.lit(-1).alias("stop")),
        lambda s, x: F.when(x["at"] <= s["stop"], F.struct(
            s["out"].alias("out"), s["at"].alias("at"), F.greatest(s["stop"], x["at"] + x["length"]).alias("stop")))
        .otherwise(F.struct(
            F.when(s["at"] < 0, s["out"]).otherwise(F.concat(s["out"], F.array(F.struct(
                s["at"].alias("at"), s["stop"].alias("stop"))))).alias("out"),
            x["at"].alias("at"), (x["at"] + x["length"]).alias("stop"))),
        lambda s: F.when(s["at"] < 0, s["out"]).otherwise(F.concat(s["out"], F.array(F.struct(
            s["at"].alias("at"), s["stop"].alias("stop"))))))


def scan(df: DataFrame, bench: DataFrame, keep: list[str], text: str = "text", item: str = "item_id",
         bench_text: str = "text", size: int = SIZE, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """``keep`` columns of ``df`` (of any names but the new ones, which are replaced) and n_words, n_hit, spans (disjoint
    (at, stop) of hit words, counted from 0, stop exclusive) and items (sorted ids, as strings, of items that occur).

    A word is hit if it lies in any occurrence of a window. One row per row of ``df``, with whatever ids and copies; null
    and empty texts have no words. Items without words hit nothing, windows of an item without an id hit but name none,
    and repeated items count once. An empty benchmark hits nothing; an empty table gives no rows. What the scan finds is
    written once to the shared folder. Only windows that the bitmap lets through are joined and shuffled, and a window
    that very many texts hold is one row for each of these texts.
    """
    if size < 1:
        raise ValueError("a window has at least one word")
    grams = stored(windows(bench, item, bench_text, size), "grams")
    about = grams.agg(F.count("*").alias("n"), F.array_sort(F.collect_set("length")).alias("lengths"), F.coalesce(F.sum(
        F.octet_length("gram") + 16 + F.aggregate("items", F.lit(0), lambda n, i: n + 16 + F.octet_length(i))), F.lit(0)).alias(
        "bytes")).first()
    kept = [name for name in keep if name not in ("n_words", "n_hit", "spans", "items")]
    words = words_of(F.col(text))
    none = F.array().cast("array<struct<at:int,length:int,gram:string>>")
    found = _candidates(F.col("words"), about["lengths"], *bitmap(grams, about["n"])) if about["n"] else none
    # in one struct no column can clash with another
    given = df.select(F.struct(*(F.col(name) for name in kept), F.lit(0).alias("-")).alias("kept"), words.alias("words"))
    base = stored(given.select("kept", F.size("words").cast("bigint").alias("n_words"), found.alias("found"),
                               F.monotonically_increasing_id().alias("row")), "scanned")
    some = F.size("found") > 0
    verified = grams.select("gram", "items")
    if about["bytes"] <= sent_bytes:
        verified = F.broadcast(verified)
    hits = base.where(some).select("row", F.explode("found").alias("hit")).select("row", "hit.*").join(verified, "gram")
    by_row = hits.groupBy("row").agg(
        F.collect_list(F.struct("at", "length")).alias("windows"),
        # the windows of a passage name the same items, so a list of them is kept once
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    no_spans = F.array().cast("array<struct<at:int,stop:int>>")
    joined = base.where(some).select("kept", "n_words", "row").join(by_row, "row", "left").select(
        "kept", "n_words", F.when(F.col("windows").isNotNull(), _covered(F.col("windows"))).otherwise(no_spans).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    clean = base.where(~some).select("kept", "n_words", no_spans.alias("spans"), F.array().cast("array<string>").alias("items"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["at"])
    return clean.unionByName(joined).select(
        *(F.col("kept").getField(name).alias(name) for name in kept), "n_words", n_hit.alias("n_hit"), "spans", "items")


def remove_spans(text: Column, spans: Column) -> Column:
    """A text without its hit words and what stands before each of them; the rest stays as it is, null stays null."""
    pieces = F.regexp_extract_all(text, F.lit(f"{_GIVEN_BETWEEN}{_GIVEN_WORD}"), F.lit(0))
    tail = F.regexp_extract(text, f"({_GIVEN_BETWEEN})$", 1)
    # between spans, pieces stay
    edges = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.struct(
        F.when(i == 0, F.lit(0)).otherwise(F.try_element_at(spans, i)["stop"]).alias("at"),
        F.coalesce(F.try_element_at(spans, i + 1)["at"], F.size(pieces)).alias("stop")))
    left = _bound(pieces, lambda found: F.array_join(F.flatten(F.transform(
        edges, lambda e: F.slice(found, e["at"] + 1, F.greatest(e["stop"] - e["at"], F.lit(0))))), ""))
    return F.when(F.size(spans) > 0, F.concat(left, tail)).otherwise(text)


def decontaminate(df: DataFrame, bench: DataFrame, action: str = "spans", share: float = 0.0, text: str = "text",
                  item: str = "item_id", bench_text: str = "text", size: int = SIZE) -> DataFrame:
    """``df`` without benchmark passages: ``spans`` cuts the hit words out of texts, ``documents`` drops those of whose
    words more than ``share`` are hit. Rows without hits stay as they are, in all columns."""
    if action not in ("spans", "documents"):
        raise ValueError("action is spans or documents")
    new = {"n_words", "n_hit", "spans", "items"}
    # columns that are named like the new ones travel under other names
    aside = {name: f"{name}-given" for name in df.columns if name in new}
    found = scan(df.withColumnsRenamed(aside), bench, [aside.get(c, c) for c in df.columns], aside.get(text, text), item,
                 bench_text, size)
    said = aside.get(text, text)
    if action == "spans":
        found = found.withColumn(said, remove_spans(F.col(said), F.col("spans")))
    else:
        found = found.where(F.col("n_hit") <= F.col("n_words") * share)
    return found.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in df.columns))
