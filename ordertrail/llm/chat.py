"""Chat formatting from event logs.

A conversation is logged as events: streamed deltas of messages, edits and regenerations. The events of each
message are folded in sequence into its final text, the messages of each conversation are put in order, and the
conversation is rendered with a template that marks turns and the text that carries loss.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Sender, arrow_schema, fields, map_batches

#: The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
#: A text's own "<|" gets a backslash after "<", and so does one that has backslashes there already.
_OWN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
LEARNED = "assistant"

#: Kinds of events. A delta adds to its message; an edit replaces what was there; a regeneration empties it.
DELTA, EDIT, REGENERATE = "delta", "edit", "regenerate"


def escape(text: str) -> str:
    return _OWN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of its text, end exclusive, that carry loss."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{END}\n")
        at += len(out[-1])
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; raises ValueError for anything else."""
    turns, at = [], 0
    while at < len(formatted):
        hit = _TURN.match(formatted, at)
        if hit is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape_role(hit[1]), unescape(hit[2])))
        at = hit.end()
    return turns


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, message_id, first (the smallest seq of the message), role, text.

    ``events`` has conv_id, seq, message_id, kind, role, text; seq orders a conversation. A message's role is that
    of its last event that states one, else empty. Its text is all text from its last edit or regeneration on, in
    sequence (at the same seq: resets first); a null text adds nothing. Events of unknown kind raise. Grouping is by
    message, so a conversation that holds a third of all events is still spread out.
    """
    resets = F.col("kind").isin(EDIT, REGENERATE)
    known = F.when(F.col("kind").isin(DELTA, EDIT, REGENERATE), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null")))))
    messages = events.select("conv_id", "message_id", "seq", known.alias("kind"), "role", "text").groupBy(
        "conv_id", "message_id").agg(
        F.min("seq").alias("first"), F.max(F.when(resets, F.col("seq"))).alias("reset"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("named"),
        F.sort_array(F.collect_list(F.struct("seq", F.when(resets, 0).otherwise(1).alias("later"), "text"))).alias("e"))
    lasting = F.filter("e", lambda e: F.col("reset").isNull() | (e["seq"] >= F.col("reset")))
    return messages.select("conv_id", "message_id", "first", F.coalesce("named.role", F.lit("")).alias("role"),
                           F.array_join(F.transform(lasting, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text"))


def format_conversations(events: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, and loss, the spans (code points, end exclusive) of the texts
    that carry loss.

    Messages go by their first seq; of equal ones by role, then text. A null conv_id is a conversation of its own;
    extra columns of ``events`` are ignored; no events give no rows. A conversation is one value of the result, so
    its messages, and only those, meet in one row.
    """
    whole = fold(events).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("first", "role", "text"))).alias("messages"))
    plain = whole.select("conv_id", F.transform("messages", lambda m: F.struct(m["role"], m["text"])).alias("messages"))
    ddl = (f"{fields(events, 'conv_id')}, formatted string, "
           "loss array<struct<start:bigint,stop:bigint>>")
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(schema)
        for batch in batches:
            for name, messages in zip(batch.column(0).to_pylist(), batch.column(1)):
                formatted, spans = render([tuple(m.values()) for m in messages.as_py()])
                if out.add(name, formatted, [{"start": a, "stop": b} for a, b in spans], size=len(formatted) + 64):
                    yield out.batch()
        yield out.batch()

    return map_batches(plain, ddl, run)


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted``, ``turns`` (role, text) and ``learned``, the unescaped text under the loss mask."""
    ddl = (f"{fields(formatted, 'conv_id')}, formatted string, "
           "turns array<struct<role:string,text:string>>, learned string")
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(schema)
        for batch in batches:
            for name, text, loss in zip(*(column.to_pylist() for column in batch.columns)):
                turns = [{"role": role, "text": said} for role, said in parse(text)]
                learned = "".join(unescape(text[s["start"]:s["stop"]]) for s in loss)
                if out.add(name, text, turns, learned, size=3 * len(text) + 64):
                    yield out.batch()
        yield out.batch()

    return map_batches(formatted.select("conv_id", "formatted", "loss"), ddl, run)
