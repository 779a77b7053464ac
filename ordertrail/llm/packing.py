"""Best-two-fit packing of tokenised documents into sequences of fixed size.

Only lengths matter to packing, and there are at most ``capacity`` of them. Documents are tokenised and cut where
they lie, and numbered within their length; the histogram of lengths (``capacity`` rows, whatever the input) is
packed into patterns with repeat counts; each piece then finds its place from its number. Nothing but the
histogram reaches the driver, and no length is gathered in one task.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from tokenizers import Tokenizer

from ..session import ship_package, stored
from .arrow import Sender, arrow_schema, fields, given_name, map_batches, unused
from .bpe import AT_ONCE, BYTES, byte_alphabet, parts

#: Pieces and words remembered per Python worker, and the longest one that is worth it; limits memory, not results.
REMEMBERED, WORTH = 150_000, 48
#: Bytes of texts whose words are told apart at once; limits memory, not results.
TOGETHER = 2 << 20
MARKS = frozenset(b".,;:!?")
#: Words of which normalising changes nothing but upper case: printable ASCII and Latin letters.
LATIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: The pre-tokenizer's pattern for such a word in lower case.
LATIN_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
ENTRIES = 4  # bytes of an id
#: Columns of a piece; a key that is named like one is called ``<name>_given``.
PIECE = ("piece", "start", "length", "ids", "task", "number", "sequence_id", "offset", "first", "place")


class WordIds(dict):
    """Ids of texts by the ``tokenizers`` library; remembers those of pieces of Latin words in lower case, and of other words.

    The tokenizer drops white space before it splits a text into pieces, so the ids of a text are those of its
    words, and each different word of some texts is looked at once. Pieces of Latin words go straight to the
    tokenizer's model, which is several times faster than its normaliser and pre-tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer, self.before = Tokenizer.from_file(path), {}
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        shown = {b: c for c, b in byte_alphabet().items()}
        self.alphabet = "".join(shown[b] for b in range(BYTES))

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            # printable ASCII stands for itself
            shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
            ids = array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
        return self._remember(piece, ids)

    def _remember(self, said: str, ids: bytes) -> bytes:
        if len(said) <= WORTH:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[said] = ids
        return ids

    def forget(self) -> None:
        """Let go of all pieces: a worker lives on after its task, and so would they."""
        self.clear()
        self.before = {}
        pa.default_memory_pool().release_unused()

    def word(self, word: str) -> bytes:
        plain = word.isascii()
        if plain and word.isalpha():
            return self[word.lower()]
        if (plain and word.isprintable() or LATIN.fullmatch(word)) and "<|" not in word:  # no special token
            return b"".join(map(self.__getitem__, LATIN_PIECES.findall(word.lower())))
        return self._remember(word, self.get(word) or self.before.get(word) or self._other(word))

    def _other(self, word: str) -> bytes:
        # normalising can turn a letter into one and a combining character, which joins the mark after it
        if ord(word[-1]) in MARKS and self._letters(word[:-1]):
            return self.word(word[:-1]) + self[word[-1]]
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _letters(self, text: str) -> bool:
        return text.isalpha() and self.tokenizer.normalizer.normalize_str(text).isalpha()

    def _together(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text; its words go by their own spelling."""
        words = pc.ascii_split_whitespace(texts)
        borders, told = words.offsets, words.flatten().dictionary_encode()
        del words
        different = told.dictionary.to_numpy(zero_copy_only=False)  # several times faster than to_pylist
        known = pa.array(map(self.word, different), pa.binary())
        return pc.binary_join(pa.ListArray.from_arrays(borders, known.take(told.indices)), b"").to_pylist()

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        # a special token is written in lower case; upper case does not make one
        said = text if "<|" in text else text.encode().lower().decode()
        return b"".join([self._together(pa.array([part]))[0] for part in parts(said)])

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """What ``encode`` returns for each text, a null one counting as empty. Texts that are long or may hold special
        tokens are encoded by themselves."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
        borders = (np.flatnonzero(np.diff(ends // TOGETHER)) + 1).tolist()
        for first, last in zip([0, *borders], [*borders, len(texts)]):
            some = pc.fill_null(texts[first:last], "")
            alone = pc.or_(pc.greater(pc.binary_length(some), AT_ONCE), pc.match_substring(some, "<|"))
            ids = self._together(pc.ascii_lower(pc.if_else(alone, "", some)))
            for at in np.flatnonzero(alone).tolist():
                ids[at] = self.encode(some[at].as_py())
            yield from ids


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """Built once per Python worker."""
    return WordIds(path)


def pieces(df: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text",
           ) -> DataFrame:
    """Token ids of every whole text and ``end_id``, cut into pieces of ``capacity`` ids.

    Columns: ``key``, ``piece``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit integers), and the
    piece's number among those of its length in its task, ``task`` and ``number``.
    """
    called = given_name(key, PIECE)
    named = df.select(F.col(key).alias(called), F.col(text).alias(unused([called], "text")))
    ddl = (f"{fields(named, called)}, piece int, start bigint, length int, ids binary, "
           "task int, number bigint")
    schema = arrow_schema(ddl)
    end, step = np.array([end_id], "<u4").tobytes(), capacity * ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out, seen, task = word_ids(path), Sender(schema), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            for name, coded in zip(batch.column(0).to_pylist(), known.encode_all(batch.column(1))):
                ids = coded + end
                for piece, first in enumerate(range(0, len(ids), step)):
                    part = ids[first:first + step]
                    length = len(part) // ENTRIES
                    if out.add(name, piece, first // ENTRIES, length, part, task, seen[length], size=len(part) + 48):
                        yield out.batch()
                    seen[length] += 1
        yield out.batch()
        known.forget()

    return map_batches(named, ddl, run)


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins for ``counts[length]`` pieces of each length: lists of lengths, each with how often it is used.

    A bin takes the longest piece that fits until none does. If a gap is left, its smallest piece is replaced by
    the two unpacked pieces that fit the gap and its room most tightly, if they fill more than it did. The same
    bin is then repeated as long as its lengths last; every pattern uses up a length for bins of its kind, so their
    number depends on ``capacity`` and not on the number of pieces.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    there = sum(1 << length for length in left)
    out = []
    while there:
        used: Counter[int] = Counter()
        free, gap, taken = there, capacity, []

        def take(length: int) -> None:
            nonlocal free, gap
            taken.append(length)
            used[length] += 1
            gap -= length
            if used[length] == left[length]:
                free &= ~(1 << length)

        while fitting := free & ((1 << gap + 1) - 1):
            take(fitting.bit_length() - 1)
        if gap and len(taken) > 1:
            smallest = taken[-1]
            two = _two_that_fit(free, left, used, gap + smallest, smallest)
            if two:
                taken.pop()
                used[smallest] -= 1
                gap += smallest
                for length in two:
                    take(length)
        used += Counter()  # without lengths that are used no more
        times = min(left[length] // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * times
            if not left[length]:
                there &= ~(1 << length)
        out.append((taken, times))
    return out


def _two_that_fit(free: int, left: dict[int, int], used: Counter, room: int, more_than: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum of at most ``room`` and over ``more_than``."""
    best, found = more_than, None
    larger = free & ((1 << room) - 1)
    while larger:
        a = larger.bit_length() - 1
        larger ^= 1 << a
        if 2 * a <= best:  # the other is not longer
            break
        others = free & ((1 << min(room - a, a) + 1) - 1)
        if others >> a & 1 and left[a] - used[a] < 2:
            others ^= 1 << a
        b = others.bit_length() - 1
        if others and a + b > best:
            best, found = a + b, (a, b)
            if best == room:
                break
    return found


class Places:
    """Where the n-th piece of a length goes; its size follows the number of patterns."""

    def __init__(self, plan: list[tuple[list[int], int]]):
        found: dict[int, list[tuple[int, int, int]]] = {}
        following: Counter[int] = Counter()
        sequence = 0
        for lengths, times in plan:
            offset = 0
            for length in lengths:
                found.setdefault(length, []).append((following[length], sequence, offset))
                following[length] += times
                offset += length
            sequence += times
        self.sequences = sequence
        self.of = {length: tuple(np.array(column, np.int64) for column in zip(*rows))
                   for length, rows in found.items()}

    def find(self, length: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, sequence, offset = self.of[length]
        at = np.searchsorted(first, numbers, "right") - 1
        return sequence[at] + numbers - first[at], offset[at]


def pack(df: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text",
         carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per piece of a document: ``key``, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``,
    ``offset``. ``carry`` names what to return in place of ``ids``, computed where the pieces lie.

    A document is its token ids and ``end_id``; only one of more than ``capacity`` ids is cut. Sequences hold at
    most ``capacity`` ids, without gaps from offset 0. A null or empty text is one piece of one id; null and
    repeated keys stay as they are, every row is packed; other columns of ``df`` are left out. An empty table
    gives no rows. The tokenised pieces are written once to the shared folder. Of each task that wrote some, one row tells
    how many of each length the tasks before hold; while these rows are small enough to be sent along, no piece is shuffled,
    and beyond that only with what ``carry`` says.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = df.sparkSession
    written = stored(pieces(df, path, capacity, end_id, key, text), "pieces")
    by_task = written.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # one row per task: how many pieces of each length the tasks before hold
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    by_length = F.array_sort(F.collect_list(F.struct("length", "first")))
    firsts = stored(before.groupBy("task").agg(by_length.alias("known")).select(
        "task", F.transform("known", lambda k: k["length"]).alias("lengths"),
        F.transform("known", lambda k: k["first"]).alias("first")), "firsts")
    ship_package(spark)
    places = spark.sparkContext.broadcast(Places(patterns(counts, capacity)))

    @pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence = np.zeros(len(length), np.int64)
        offset = np.zeros(len(length), np.int64)
        order = np.argsort(length.to_numpy(), kind="stable")
        sizes, starts = np.unique(length.to_numpy()[order], return_index=True)
        numbers = number.to_numpy()
        for size, rows in zip(sizes.tolist(), np.split(order, starts[1:])):
            if len(rows):
                sequence[rows], offset[rows] = places.value.find(size, numbers[rows])
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    carried = carry or {"ids": F.col("ids")}
    called = given_name(key, PIECE)
    narrow = written.select(called, "piece", "start", "length", "task", "number", *(
        c.alias(unused([called, *PIECE], f"carried-{i}")) for i, c in enumerate(carried.values())))
    placed = narrow.join(firsts, "task").select(
        *narrow.columns, place("length", F.col("number") + F.element_at("first", F.array_position("lengths", F.col("length")).cast("int"))).alias("place"))
    return placed.select(called, "piece", "start", F.col("length").cast("bigint").alias("length"), *(
        F.col(f"`{column}`").alias(name) for column, name in zip(narrow.columns[6:], carried)), "place.sequence_id", "place.offset")
