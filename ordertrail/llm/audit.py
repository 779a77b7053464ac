"""How the filters of a corpus act on each other, in every order in which they can be applied.

Which filters a document fails is one number, its mask. Documents are counted once, by part and mask; from there on the
work does not depend on their number. A recursive query extends every prefix of filters by each unused one, for every
mask, and carries the bits of the filters applied so far; each level of the recursion gives the metrics of that step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored

SPACES = r"[\x20\x09-\x0D]+"
#: Letters of the filters, in the order of their bits.
FILTERS = "ABCDE"


@dataclass(frozen=True)
class Limits:
    """Fewest words, least distinct words and most capitals of 100, and the symbols that no document may hold."""

    words: int = 200
    distinct: int = 50
    capitals: int = 3
    symbols: str = "#$%&*|"


def failures(text: Column, limits: Limits = Limits()) -> list[Column]:
    """Whether a text that is not null fails A, B, C and D: short, repetitive, loud, or with symbols."""
    # the words are split once and counted twice
    words = F.filter(F.split(text, SPACES, -1), lambda w: w != "")
    counts = F.transform(F.array(words), lambda w: F.struct(
        F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("distinct")))[0]
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [counts["all"] < limits.words, 100 * counts["distinct"] < limits.distinct * counts["all"],
            100 * capitals > limits.capitals * F.length(text), text.rlike(f"[{limits.symbols}]")]


def mask_cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
               limits: Limits = Limits()) -> DataFrame:
    """Documents by part, mask (bit *i* is set if the *i*-th filter fails), and label: (part, mask, n, good, toxic).

    E fails for a text that a smaller id has too, in whatever part. Rows that repeat an id with one text are not smaller
    than each other, and a null id is neither smaller nor larger than any. Null texts and parts count as empty. A document
    is good or toxic if any row of ``labels`` says so. Documents are reduced to a few numbers and the text's SHA-256 before
    anything is shuffled, and copies are counted before they meet, so a text that a third of all rows holds is a row per
    task, part and label.
    """
    said = F.coalesce(F.col(text), F.lit(""))
    bits = [F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(failures(F.col("said"), limits))]
    narrow = docs.select(F.col(key).alias("key"), said.alias("said"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    judged = narrow.select("key", "part", F.unhex(F.sha2("said", 256)).alias("same"), sum(bits, F.lit(0)).alias("bits"))
    labelled = labels.groupBy(F.col(key).alias("key")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic")).where("good = 1 or toxic = 1")
    rows = stored(judged, "judged").join(stored(labelled, "labelled"), "key", "left")
    every = ["same", "bits", "part", "good", "toxic"]
    marked = rows.select("key", "same", "bits", "part", F.coalesce("good", F.lit(0)).alias("good"),
                         F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # repeated rows are one row with a count, so the smallest id of a group has its count next to it
    counted = marked.groupBy("key", *every).agg(F.count("*").alias("n"))
    groups = counted.groupBy(*every).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("key").isNotNull(), F.struct("key", "n"))).alias("first"))
    # rows of a text: one per part and label
    smallest = F.min("first.key").over(Window.partitionBy("same"))
    met = groups.withColumn("smallest", smallest)
    passing = F.col("nameless") + F.when(F.col("first.key") == F.col("smallest"), F.col("first.n")).otherwise(0)
    repeats = 1 << FILTERS.index("E")
    split = F.array(F.struct(F.col("bits").alias("mask"), passing.alias("n")),
                    F.struct((F.col("bits") + repeats).alias("mask"), (F.col("n") - passing).alias("n")))
    cells = met.select("part", "good", "toxic", F.inline(split)).where("n > 0")
    return cells.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def prefixes(spark: SparkSession, filters: str = FILTERS) -> DataFrame:
    """All prefixes of all orders of ``filters``, for every mask: (mask, prefix, step, before, bit).

    ``before`` has the bits of the filters applied earlier, ``bit`` is that of the prefix's last filter. The rows depend on
    the number of filters alone: 10,400 for five.
    """
    letters = ", ".join(f"('{letter}', {1 << i})" for i, letter in enumerate(filters))
    return spark.sql(f"""
        WITH RECURSIVE letters AS (SELECT * FROM VALUES {letters} AS t(letter, bit)),
        walk(mask, prefix, step, before, bit) AS (
            SELECT CAST(id AS INT), CAST('' AS STRING), 0, 0, 0 FROM range({1 << len(filters)})
            UNION ALL
            SELECT mask, concat(prefix, letter), step + 1, before | walk.bit, letters.bit
            FROM walk JOIN letters ON ((before | walk.bit) & letters.bit) = 0)
        SELECT * FROM walk WHERE step > 0""")


def interactions(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What every filter does at every step of every order: part, filter_order, step, and counts of documents.

    kept after the step, removed by it, redundant (its filter fails them, an earlier one removed them), unique_fails (its
    filter alone fails them), good_lost and toxic_lost (of the removed ones), and shapley, what its filter removes in all
    orders together. ``cells`` are those of ``mask_cells``. Every part that has a document has a row for every order and
    step; without documents there are no rows. There are 32 cells a part at most, so from the cells on only the number of
    parts counts; parts are never gathered.
    """
    if not filters or len(set(filters)) < len(filters) or not filters.isalpha() or len(filters) > 7:
        raise ValueError("filters are named by one to seven different letters")
    # of fixed size, so it goes to every task
    walk = F.broadcast(stored(prefixes(cells.sparkSession, filters), "prefixes"))
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(column: str, which: Column) -> Column:
        return F.sum(F.when(which, F.col(column)).otherwise(0))

    metrics = cells.join(walk, "mask").groupBy("part", "prefix", "step").agg(
        total("n", ~fails & ~gone).alias("kept"), total("n", fails & ~gone).alias("removed"),
        total("n", fails & gone).alias("redundant"), total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        total("good", fails & ~gone).alias("good_lost"), total("toxic", fails & ~gone).alias("toxic_lost"))
    steps = F.sequence(F.lit(1), F.lit(len(filters)))
    orders = walk.where((F.col("step") == len(filters)) & (F.col("mask") == 0)).select(
        F.col("prefix").alias("filter_order"), F.explode(steps).alias("at")).select(
        "filter_order", F.expr("substring(filter_order, 1, at)").alias("prefix"))
    # an order of five filters has 120 rows a part and filter, in all parts alike
    per_filter = Window.partitionBy("part", F.substring("prefix", -1, 1))
    return metrics.join(F.broadcast(orders), "prefix").withColumn("shapley", F.sum("removed").over(per_filter)).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
