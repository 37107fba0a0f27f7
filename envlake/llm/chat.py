"""Chat formatting with a grammar round trip.

A conversation is its turns, one after the other:

    ### role: text</turn>\\n

A backslash before \\, ### or </turn> makes these part of a role or a text. Each
turn is first written as it is. It is parsed back by the same deterministic
parser that reads whole conversations; only if what comes back differs, its
control strings are escaped, then its role too, until it is identical.

Rows are put in order with a shuffle by conversation and a sort; a task streams
through its rows and holds one turn and the digests of one conversation, so the
length of a conversation doesn't matter.

Defined results: a null text is empty; a null role is the empty role; turns are
ordered by number (null first), then role and text, and repeated rows are
repeated turns; rows with a null conversation id are one conversation; the loss
mask covers the texts of turns whose role is exactly "assistant".
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>"
_CONTROL = re.compile(r"\\|###|</turn>")
_TOKEN = re.compile(r"\\(\\|###|</turn>)|###|</turn>")
_ROLE = re.compile(r"\\|###|</turn>|: ")
_ROLE_TOKEN = re.compile(r"\\(\\|###|</turn>|: )|###|</turn>|: ")
_HEAD = r"(?s)^### (?:\\(?:\\|###|</turn>|: )|(?!: ).)*: "
LEARNT = "assistant"


class GrammarError(ValueError):
    """Text that no conversation renders to."""


def _escaped(control: re.Pattern, text: str) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def _read(token: re.Pattern, formatted: str, at: int, end: str) -> tuple[str, int]:
    """What stands from at to the first unescaped end, unescaped, and where that end stops."""
    parts, last = [], at
    for m in token.finditer(formatted, at):
        parts.append(formatted[last : m.start()])
        if m[1] is not None:
            parts.append(m[1])
        elif m[0] == end:
            return "".join(parts), m.end()
        else:
            raise GrammarError(f"{m[0]!r} inside a turn, at {m.start()}")
        last = m.end()
    raise GrammarError("a turn has no end")


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation or of some of its turns."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise GrammarError(f"no turn begins at {at}")
        role, at = _read(_ROLE_TOKEN, formatted, at + len(OPEN), AFTER_ROLE)
        text, at = _read(_TOKEN, formatted, at, CLOSE)
        if not formatted.startswith("\n", at):
            raise GrammarError(f"a turn goes on at {at}")
        at += 1
        yield role, text


def render(role: str, text: str) -> str:
    """One turn, escaped no more than needed for the parser to give the same turn back."""
    for head, body in ((role, text), (role, _escaped(_CONTROL, text)), (_escaped(_ROLE, role), _escaped(_CONTROL, text))):
        turn = f"{OPEN}{head}{AFTER_ROLE}{body}{CLOSE}\n"
        try:
            if list(parse(turn)) == [(role, text)]:
                return turn
        except GrammarError:
            continue
    raise GrammarError(f"the role {role!r} can't be written")


def format_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, formatted): each turn with its part of the formatted conversation."""

    @F.pandas_udf("string")
    def rendered(roles, texts):
        import pandas as pd

        return pd.Series([render(r, t) for r, t in zip(roles, texts, strict=True)], dtype=object)

    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.withColumn("formatted", rendered("role", "text"))


def format_conversations(conversations: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, i, role, formatted, start, loss_from, loss_to): conversations as their formatted turns in order, i from 0.

    Joined in order they are the conversation's text; a turn starts at its code point
    start, and what is learnt of it stands in [loss_from, loss_to), null for other roles. A
    conversation of any length is never one row.
    """
    turns = format_turns(conversations, **columns)
    # a text begins after the first unescaped end of the role, and ends before CLOSE and the line feed
    n, head = F.length("formatted"), F.length("formatted") - F.length(F.regexp_replace("formatted", _HEAD, ""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    start = F.coalesce(F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("bigint")
    placed = turns.select("conv_id", (F.row_number().over(order) - 1).alias("i"), "role", "formatted", start.alias("start"), n.alias("n"), head.alias("head"))
    learnt = F.col("role") == LEARNT
    return placed.select("conv_id", "i", "role", "formatted", "start", F.when(learnt, F.col("start") + F.col("head")).alias("loss_from"), F.when(learnt, F.col("start") + F.col("n") - len(CLOSE) - 1).alias("loss_to"))


def digests(turns: DataFrame) -> DataFrame:
    """What each conversation's formatted turns give when parsed back: a row of counts and digests for each."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for key, formatted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is None or key != now:
                    if state is not None:
                        done.append((now, state))
                    now, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[4] += len(formatted)
                for role, text in parse(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == LEARNT:
                        state[2] += len(text)
                        state[3].update(text.encode())
            if done:
                yield made(done)
        if state is not None:
            yield made([(now, state)])

    def made(done: list) -> pa.RecordBatch:
        rows = [(key, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]) for key, s in done]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select(F.col("conv_id").cast("bigint").alias("conv_id"), "formatted").mapInArrow(read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
