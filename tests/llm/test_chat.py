"""Folding event logs, and the exact way back from formatted conversations."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordertrail.llm import chat
from ordertrail.llm.queries import CONTROL, op9_chat_formatting

TEXT = st.lists(st.one_of(st.sampled_from(["<", "|", "\\", "<|im_end|>", "<|im_start|>", "\n", "<\\|"]),
                          st.characters(exclude_categories=["Cs"]))).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), TEXT), TEXT), max_size=6))
def test_round_trip(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert formatted.count(chat.START) == len(turns) == formatted.count(chat.END)


def test_no_conversation():
    with pytest.raises(ValueError):
        chat.parse("<|im_start|>user\nhello")


EVENTS = "conv_id long, seq long, message_id long, kind string, role string, text string, extra string, first int"


def test_fold(spark):
    events = [
        (1, 1, 1, "delta", "user", "hel"), (1, 2, 1, "delta", None, "lo"),
        (1, 3, 2, "delta", "assistant", "draft"), (1, 4, 2, "regenerate", None, None), (1, 5, 2, "delta", None, "fin"),
        (1, 6, 2, "delta", None, "al"), (1, 7, 1, "edit", None, "bye"), (1, 8, 1, "delta", None, "!"),
        (2, 5, 9, "delta", "user", None), (2, 1, 4, "delta", None, "first"), (2, 1, 4, "regenerate", None, None),
        (None, 1, 1, "delta", "assistant", "nobody's"), (None, 1, 1, "delta", "assistant", "nobody's")]
    df = spark.createDataFrame([(*e, "x", 3) for e in events], EVENTS)
    found = {(r["conv_id"], r["message_id"]): (r["role"], r["text"]) for r in chat.fold(df).collect()}
    assert found == {(1, 1): ("user", "bye!"), (1, 2): ("assistant", "final"), (2, 9): ("user", ""), (2, 4): ("", "first"),
                     (None, 1): ("assistant", "nobody'snobody's")}
    whole = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert [tuple(t) for t in whole[1]["turns"]] == [("user", "bye!"), ("assistant", "final")]
    assert whole[1]["learned"] == "final" and len(whole) == 3
    assert [t["text"] for t in whole[2]["turns"]] == ["first", ""]
    assert chat.format_conversations(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="unknown kind"):
        chat.fold(spark.createDataFrame([(1, 1, 1, None, "u", "x", "x", 3)], EVENTS)).collect()


def test_long_conversation(spark):
    events = spark.range(20_000).selectExpr(
        "1L conv_id", "id seq", "id div 2 message_id", "'delta' kind", "IF(id % 4 < 2, 'user', 'assistant') role",
        "concat('t', id, ' ') text")
    (row,) = chat.read_back(chat.format_conversations(events)).collect()
    assert len(row["turns"]) == 10_000
    assert row["learned"] == "".join(f"t{i} " for i in range(20_000) if i % 4 >= 2)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark, folder):
    conversations = {-1: [(0, "user", CONTROL), (1, "assistant", CONTROL)]}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        conversations.setdefault(r["conv_id"], []).append((r["turn"], r["role"] or "", r["text"] or ""))
    rows = {r["conv_id"]: r for r in op9_chat_formatting(spark, folder).collect()}
    assert set(rows) == set(conversations)
    for conv_id, turns in conversations.items():
        turns.sort()
        learned = "".join(t for _, role, t in turns if role == "assistant")
        r = rows[conv_id]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == sha("".join(f"{role}\n{t}\n" for _, role, t in turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), sha(learned))
        assert r["formatted_chars"] == len(chat.render([t[1:] for t in turns])[0])
