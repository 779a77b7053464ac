"""Backtracking BPE against the tokenizers library, and the exact round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ordertrail.llm import bpe
from ordertrail.llm.queries import op3_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = ["", " ", "\n \n", "a" * 5000, "abcabcabc" * 300, "aaaa bbbb  \n\n  c<|endoftext|> x <|endoftext|>",
        "\x1c\x1d x\x85y  z's 'S they'LL we'll", "你好世界 🤖🤖🤖 ​  foo", "\xa0\xa0x", "́e ́", "\x00\x01", "٣٤٥ ¾ Ⅷ",
        "don't!!! (really?) 100.000,00 €", "the., of"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(coded):
    return np.frombuffer(coded, "<u4").tolist()


def test_same_ids_as_the_library(library):
    rnd = random.Random(3)
    texts = HARD + ["".join(rnd.choice("aeinrst  \n'lhd.,0é中<|>") for _ in range(rnd.randint(0, 80))) for _ in range(1500)]
    pairs = bpe.tables(PATH)
    for text, coded in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids(pairs.encode(text)) == coded.ids, text
        assert pairs.decode(pairs.encode(text)) == library.decode(coded.ids, skip_special_tokens=False) == text


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])))
def test_any_text(text):
    library = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "library") else test_any_text.library
    test_any_text.library = library
    pairs = bpe.tables(PATH)
    assert ids(pairs.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert pairs.decode(pairs.encode(text)) == text


def test_remembering_does_not_change_ids(monkeypatch):
    pairs = bpe.BytePairs(PATH)
    text = " ".join(f"word{i % 50} anotherone{i}" for i in range(400))
    whole = pairs.encode(text)
    monkeypatch.setattr(bpe, "REMEMBERED", 7)
    assert bpe.BytePairs(PATH).encode(text) == whole


def test_long_texts_in_parts(library, monkeypatch):
    rnd = random.Random(8)
    text = "".join(rnd.choice(["word", " ", "  ", "\n", " a", "é,", "\xa0", "<|endoftext|>"]) for _ in range(6000))
    assert "".join(bpe.parts(text, 50)) == text and len(list(bpe.parts(text, 50))) > 20
    cut = lambda said: bpe_parts(said, 50)
    bpe_parts = bpe.parts
    monkeypatch.setattr(bpe, "parts", cut)
    assert ids(bpe.tables(PATH).encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_rows(spark):
    rows = [(1, None, "x"), (1, "the cat", "y"), (1, "the cat", "y"), (None, "", "z"), (5, "a" * 200_000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.encode(df, PATH)
    assert coded.columns == ["doc_id", "ids"]
    back = bpe.decode(coded, PATH).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in back) == sorted(
        (d is None, d, t or "") for d, t, _ in rows)
    assert bpe.decode(bpe.encode(df.limit(0), PATH), PATH).count() == 0


def test_query(spark, folder, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op3_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for row, coded in zip(rows, library.encode_batch([texts[r["doc_id"]] for r in rows], add_special_tokens=False)):
        assert row["n_tokens"] == len(coded.ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(coded.ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
