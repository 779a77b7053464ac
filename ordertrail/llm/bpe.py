"""Byte-level BPE: linear-time encoding by backtracking, decoding by an offset table.

A merge-by-merge encoder repeats work on long pieces. This one walks from left to right and takes the longest
token that an Aho-Corasick automaton finds at the byte it has reached, if the token before it is *compatible*: two neighbours are compatible if no merge across their border would have come before the
merges that made them. Where no token fits, the walk steps back once and never returns to that byte, so each
byte is left at most once per token that ends there. The result is exactly that of the merges.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Sender, arrow_schema, fields, given_name, map_batches, unused

#: The pre-tokenizer's pattern, and the white space of Unicode.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = r"\t-\r \x85\xa0  -     　"
#: No piece crosses the end of such a chunk, so chunks can be encoded, and remembered, one by one.
CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Chunks remembered per Python worker, and the longest one that is worth it; limits memory, not results.
REMEMBERED, WORTH = 120_000, 48
MARKS = frozenset(".,;:!?")
BYTES = 256
DECODED_AT_ONCE = 1 << 16
#: Characters encoded at once, and where a longer text may be cut.
AT_ONCE = 1 << 20
BORDER = re.compile(rf"(?<=[^{SPACE}]) (?=[^{SPACE}])")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary file: printable ones for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(BYTES) if b not in shown]
    return {chr(b): b for b in shown} | {chr(BYTES + i): b for i, b in enumerate(hidden)}


class BytePairs:
    """Tables of one vocabulary file of the ``tokenizers`` library with a byte-level BPE model.

    Inside, a token's number is its rank: a byte is its value, the token of merge *r* is 256 + *r*.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        spelled = lambda token: bytes(alphabet[c] for c in token)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        shown = {b: c for c, b in alphabet.items()}
        names = [shown[b] for b in range(BYTES)] + [left + right for left, right in merges]
        rank = {name: r for r, name in enumerate(names)}
        if len(rank) != len(names):
            raise ValueError("two merges make the same token")
        self.count = len(names)
        self.words = [spelled(name) for name in names]
        self.length = [len(w) for w in self.words]
        self.parts = [(-1, -1)] * BYTES + [(rank[left], rank[right]) for left, right in merges]
        self.merged = {left * self.count + right: BYTES + r for r, (left, right) in enumerate(self.parts[BYTES:])}
        by_word = {w: r for r, w in enumerate(self.words)}
        #: the longest token that a token begins with, but itself
        self.shorter = [next((by_word[w[:k]] for k in range(len(w) - 1, 0, -1) if w[:k] in by_word), -1)
                        for w in self.words]
        self.matcher = ahocorasick.Automaton()
        for r, word in enumerate(self.words):
            self.matcher.add_word(word.decode("latin-1"), r)
        self.matcher.make_automaton()
        self.ids = [spec["model"]["vocab"][name] for name in names]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {text: array("I", [i]).tobytes() for text, i in special.items()}
        self.special_split = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.pieces = regex.compile(PIECES)
        self.checked: dict[int, bool] = {}
        self.known = Remembered(self)
        spellings = dict(zip(self.ids, self.words)) | {i: text.encode() for text, i in special.items()}
        table = [spellings.get(i, b"") for i in range(max(spellings) + 1)]
        self.blob = np.frombuffer(b"".join(table), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(w) for w in table])])

    def compatible(self, left: int, right: int) -> bool:
        """True if merging the bytes of both keeps the border between them.

        The merges that made the two are undone, latest first; a merge across the border that ranks before
        everything undone so far would have been made instead. At equal rank the leftmost merge comes first.
        """
        before = self.count
        while self.merged.get(left * self.count + right, self.count) >= before:
            if max(left, right) < BYTES:
                return True
            if left > right:
                before, left = left, self.parts[left][1]
            else:
                before, right = right + 1, self.parts[right][0]
        return False

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ranks of the tokens of one piece."""
        size, length, shorter, count, checked = len(piece), self.length, self.shorter, self.count, self.checked
        spelled, longest_from = piece.decode("latin-1"), self.matcher.iter_long
        longest = longest_from(spelled)
        last, token = next(longest)
        if last + 1 == size:
            return [token]
        dead = bytearray(size + 1)
        path = [token]
        at = last + 1
        before = token * count
        last, token = next(longest)
        end = last + 1
        while True:
            if not dead[end]:
                fits = checked.get(before + token)
                if fits is None:
                    if len(checked) >= REMEMBERED:
                        checked.clear()
                    fits = checked[before + token] = self.compatible(path[-1], token) if path else True
                if fits:
                    path.append(token)
                    if end == size:
                        return path
                    before = token * count
                    if end != last + 1:  # off the automaton's own walk
                        longest = longest_from(spelled, end)
                    at = end
                    last, token = next(longest)
                    end = last + 1
                    continue
            token = shorter[token]
            while token < 0:  # nothing that starts here fits
                dead[at] = 1
                token = path.pop()
                at -= length[token]
                token = shorter[token]
                before = path[-1] * count if path else -count * count
            end = at + length[token]

    def encode_chunk(self, chunk: str) -> bytes:
        pieces = self.split(chunk)
        if len(pieces) > 1:
            return b"".join(map(self.known.__getitem__, pieces))
        return array("I", map(self.ids.__getitem__, self.encode_piece(chunk.encode()))).tobytes()

    def split(self, chunk: str) -> list[str]:
        """Pieces of a chunk; the pattern is not needed for a word, alone or before a mark."""
        word = chunk[1:] if chunk[0] == " " else chunk
        if word.isalpha() or not word:
            return [chunk]
        if word[-1] in MARKS and word[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.pieces.findall(chunk)

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        out, start = [], 0
        for hit in self.special_split.finditer(text):
            out += [self.encode_plain(text[start:hit.start()]), self.special[hit[0]]]
            start = hit.end()
        out.append(self.encode_plain(text[start:] if start else text))
        return b"".join(out)

    def encode_plain(self, text: str) -> bytes:
        """Ids of a text without special tokens, some of it at a time."""
        known = self.known.__getitem__
        return b"".join([b"".join(map(known, CHUNK.findall(part))) for part in parts(text)])

    def decode(self, ids: bytes) -> str:
        """The text of token ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        tokens = np.frombuffer(ids, "<u4")
        out = []
        for first in range(0, len(tokens), DECODED_AT_ONCE):
            some = tokens[first:first + DECODED_AT_ONCE]
            starts = self.offsets[some]
            sizes = self.offsets[some + 1] - starts
            ends = np.cumsum(sizes)
            out.append(self.blob[np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)].tobytes())
        return b"".join(out).decode("utf-8", "replace")


def parts(text: str, size: int = AT_ONCE) -> Iterator[str]:
    """A long text cut before single spaces between words, where a chunk ends for sure."""
    start = 0
    while len(text) - start > size:
        hit = BORDER.search(text, start + size)
        if hit is None:
            break
        yield text[start:hit.start()]
        start = hit.start()
    yield text[start:] if start else text


class Remembered(dict):
    """Token ids of the chunks seen lately; the ones before them are kept until as many new ones came."""

    def __init__(self, pairs: BytePairs):
        super().__init__()
        self.pairs, self.before = pairs, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            ids = self.pairs.encode_chunk(chunk)
        if len(chunk) <= WORTH:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


@lru_cache(maxsize=2)
def tables(path: str) -> BytePairs:
    """Built once per Python worker."""
    return BytePairs(path)


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids``: the token ids of every whole text, as little-endian unsigned 32-bit integers.

    ``path`` names the vocabulary file, which every worker reads from its own installation. A null text counts
    as empty and has no ids; a null or repeated key stays as it is, one row of output per row of input; one that is
    named ``ids`` is called ``ids_given``. Special
    tokens written out in a text become their ids. No shuffle, and nothing is held beyond one batch of rows.
    """
    called = given_name(key, ["ids"])
    named = df.select(F.col(key).alias(called), F.col(text).alias(unused([called], "text")))
    ddl = f"{fields(named, called)}, ids binary"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, out = tables(path), Sender(schema)
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = pairs.encode(value.as_py() or "")
                if out.add(name, ids, size=len(ids) + 16):
                    yield out.batch()
        yield out.batch()

    return map_batches(named, ddl, run)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the column ``text`` (replaced if there is one): what the token ids spell. Null ids: empty."""
    kept = [name for name in df.columns if name != text]
    ddl = f"{fields(df, *kept)}, `{text}` string"
    schema = arrow_schema(ddl)
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, out = tables(path), Sender(schema)
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                spelled = pairs.decode(row[at] or b"")
                if out.add(*row, spelled, size=len(spelled) + len(row[at] or b"") + 16):
                    yield out.batch()
        yield out.batch()

    return map_batches(df.select(*kept), ddl, run)
