"""Chat formatting with budgeted windows.

Turns of a conversation stand in order of turn (then role, then text) and are written as

    <s>{role}\\n{text}</s>\\n

with every ``\\`` of a role or text written ``\\\\`` and every ``<`` written ``\\<``: no control
string can stand inside a text, and reading it back gives the same text.  A line break in a role
is written ``\\n`` (backslash, n).

A conversation is cut into windows.  Prefix sums of the turns' tokens choose, from each window's
first new turn on, the longest span of whole turns that fits the budget beside the repeated
turns: the system turn (a first turn of that role) and up to ``HISTORY`` turns before the
span, as far as a quarter of the budget goes.  A turn that alone exceeds the budget is a window of
its own, whole.  The loss mask holds the assistant texts among the new turns; repeated turns are
masked out, so each assistant text counts once.

Rows stream through sorted partitions: a task holds one window's turns and the history, never a
whole conversation.

Defined results: null texts and roles are empty; a null conversation is one of its own; turns of
equal number follow each other by role and text, repeated rows are turns of their own; an empty
table has no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's fixed values.
OPEN, CLOSE = "<s>", "</s>\n"
SYSTEM, ASSISTANT = "system", "assistant"

_BODY = re.compile(r"(?:[^\\<]+|\\.)*", re.S)

BUDGET = 1024
HISTORY = 4
BATCH = 256


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def written(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, begin and end of the text in it)."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parsed(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin, end) of every turn of a formatted string."""
    out, at = [], 0
    while at < len(formatted):
        assert formatted.startswith(OPEN, at)
        line = formatted.index("\n", at)
        end = _BODY.match(formatted, line + 1).end()
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], formatted[at + len(OPEN):line], flags=re.S)
        out.append((role, unescape(formatted[line + 1:end]), line + 1, end))
        at = end + len(CLOSE)
    return out


@dataclass
class Windows:
    """Cuts one conversation's turns into windows as they come."""
    conv: int | None
    budget: int
    history_turns: int
    system: tuple | None = None
    past: deque = field(default_factory=deque)
    span: list = field(default_factory=list)
    tokens: int = 0  # prefix sum of the span's turns
    window: int = 0
    turns: int = 0

    def repeated(self) -> list[tuple]:
        """The system turn and the history that a window beginning now repeats."""
        kept, room = [], self.budget // 4
        for turn in reversed(self.past):
            if turn[2] > room or len(kept) == self.history_turns:
                break
            kept.append(turn)
            room -= turn[2]
        return ([self.system] if self.system else []) + kept[::-1]

    def add(self, role: str, text: str, tokens: int) -> list[dict]:
        """Windows that are complete now that this turn is known."""
        done = []
        if self.span and self.head + self.tokens + tokens > self.budget:
            done.append(self.close())
        if not self.span:
            self.lead = self.repeated()
            self.head = sum(t[2] for t in self.lead)
            if self.head + tokens > self.budget:  # a long turn repeats the system turn only
                self.lead = [self.system] if self.system else []
                self.head = sum(t[2] for t in self.lead)
        self.span.append((role, text, tokens))
        self.tokens += tokens
        return done

    def close(self) -> dict:
        parts, loss, at = [], [], 0
        for i, (role, text, _) in enumerate([*self.lead, *self.span]):
            made, begin, end = written(role, text)
            if i >= len(self.lead) and role == ASSISTANT:
                loss.append({"begin": at + begin, "end": at + end})
            parts.append(made)
            at += len(made)
        row = {"conv": self.conv, "window": self.window, "first_turn": self.turns, "repeated": len(self.lead),
               "formatted": "".join(parts), "loss": loss, "tokens": self.head + self.tokens}
        for turn in self.span:
            if not self.turns and turn[0] == SYSTEM:
                self.system = turn
            else:
                self.past.append(turn)
            self.turns += 1
        while len(self.past) > self.history_turns:
            self.past.popleft()
        self.span, self.tokens, self.window = [], 0, self.window + 1
        return row


_SCHEMA = pa.schema([("conv", pa.int64()), ("window", pa.int64()), ("first_turn", pa.int64()), ("repeated", pa.int64()),
                     ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                     ("tokens", pa.int64())])
SCHEMA = ("conv long, window long, first_turn long, repeated long, formatted string, "
          "loss array<struct<begin:long,end:long>>, tokens long")


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv, window, first_turn (number of its first new turn), repeated (turns
    before that one that are repeated), formatted, loss (spans of code points), tokens."""
    whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), whole(role).alias("role"), whole(text).alias("text"))
    # a turn's tokens: its words and single signs, two for the template
    rows = rows.withColumn("tokens", F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")) + 2)
    rows = rows.repartition(F.col("conv")).sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for key, who, said, tokens in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text", "tokens")), strict=True):
                if now is None or key != now.conv:
                    if now is not None:
                        out.append(now.close())
                    now = Windows(key, budget, history)
                out += now.add(who, said, tokens)
                if len(out) >= BATCH:
                    yield pa.RecordBatch.from_pylist(out, _SCHEMA)
                    out = []
        if now is not None:
            out.append(now.close())
        if out:
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    return rows.mapInArrow(run, SCHEMA)


def read_back(windows: DataFrame) -> DataFrame:
    """conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars: from the formatted
    strings and the loss spans alone."""
    rows = windows.repartition(F.col("conv")).sortWithinPartitions("conv", "window")
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for key, repeated, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv", "repeated", "formatted", "loss")), strict=True):
                if now is None or key != now[0]:
                    if now is not None:
                        out.append([now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]])
                    now = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parsed(formatted)[repeated:]:
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescape(formatted[span["begin"]:span["end"]])
                    now[3] += len(text)
                    now[4].update(text.encode())
                now[5] += len(formatted)
        if now is not None:
            out.append([now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]])
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in out], pa.schema(
                [(n, pa.string() if "sha" in n else pa.int64()) for n in names]))

    return rows.mapInArrow(run, "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
