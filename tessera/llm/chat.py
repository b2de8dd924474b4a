r"""Operator 1: chat formatting in budgeted windows.

A turn is written as ``<|im_start|>role\ntext<|im_end|>\n``. Control strings
inside texts are escaped reversibly: every ``<|`` (and every ``<\|``, ``<\\|``,
...) gets one more backslash, so none is left; a role escapes backslashes and
line ends.

Turns are numbered by their place in the conversation and cut into segments of
``SEGMENT`` turns, so one long conversation is formatted by many tasks. In a
segment the prefix sums of the turns' token counts choose the longest spans of
whole turns that fit the budget beside their context: the conversation's first
system turn, and the latest turns before the span, limited in number and
tokens. Context is never under the loss mask, so an assistant text is a target
once. The last turns before a segment come with it as history, so only spans
end at a segment's edge. Context gives way to the span's first turn: first the
history, then the system turn. So a window exceeds the budget only if it is
one turn that does by itself; such a turn is never cut.

Defined cases: null texts and roles are empty strings; turns are ordered by
turn (null last), then role and text, repeated rows included; a null
conv_id is one conversation; an empty table gives no rows; only the four
named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.scan import keyed_scan
from .common import slices
from .tokens import worker_encoder

#: Tokens of a window; share of it for history; turns of history; turns of a segment.
BUDGET, HISTORY_SHARE, HISTORY_TURNS, SEGMENT = 2048, 0.25, 4, 256
#: Turns held before spans are chosen; bounds a task's memory where many turns share a number.
HELD_TURNS = 512
START, END = "<|im_start|>", "<|im_end|>\n"
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
#: Rows of a segment: its conversation's system turn, the history before it, its own turns.
SYSTEM_ROW, HISTORY_ROW, OWN_ROW = 0, 1, 2

WINDOW_SCHEMA = ("conv_id long, segment long, window long, text string, context_chars long, n_turns long, "
                 "n_tokens long, loss array<struct<start:long,end:long>>")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """(the turn, where its text begins and ends)."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in a formatted text."""
    at = 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError("not a formatted turn")
        line = text.index("\n", at)
        end = text.index(END, line)
        yield unescape_role(text[at + len(START):line]), unescape(text[line + 1:end])
        at = end + len(END)


class Segment:
    """Chooses the windows of one segment, turn by turn, in bounded memory."""

    def __init__(self, conv_id, segment: int, budget: int):
        self.conv_id, self.segment, self.budget = conv_id, segment, budget
        self.system: tuple[str, int, int] | None = None  # text, tokens, place
        self.turns: list[tuple[str, int, int, int, str, int]] = []  # text, text start, text end, tokens, role, place
        self.past: list[tuple[str, int, int]] = []
        self.windows = 0

    def remember(self, turn: tuple[str, int, int]) -> None:
        self.past = self.past[-HISTORY_TURNS + 1:] + [turn]

    def context(self, first: int) -> list[tuple[str, int, int]]:
        """The system turn and the history that fit the budget beside a turn of ``first`` tokens."""
        system = [self.system] if self.system and self.system[1] + first <= self.budget else []
        history, room = [], min(int(self.budget * HISTORY_SHARE), self.budget - first - sum(t[1] for t in system))
        for turn in reversed(self.past):
            if (self.system and turn[2] == self.system[2]) or turn[1] > room:
                break
            room -= turn[1]
            history.insert(0, turn)
        return system + history

    def choose(self, final: bool) -> Iterator[tuple]:
        """Windows of the turns held; the last span stays held unless the segment ends."""
        sums = np.cumsum([t[3] for t in self.turns])
        at = 0
        while at < len(self.turns):
            context = self.context(self.turns[at][3])
            before = int(sums[at - 1]) if at else 0
            room = self.budget - sum(t[1] for t in context)
            stop = max(at + 1, int(np.searchsorted(sums, before + room, "right")))
            if stop >= len(self.turns) and not final:
                break
            yield self.window(context, self.turns[at:stop])
            at = stop
        self.turns = self.turns[at:]

    def window(self, context: list[tuple[str, int]], span: list) -> tuple:
        head = "".join(t[0] for t in context)
        loss, at = [], len(head)
        for text, begin, end, tokens, role, place in span:
            if role == TARGET_ROLE:
                loss.append({"start": at + begin, "end": at + end})
            at += len(text)
            turn = (text, tokens, place)
            if role == SYSTEM_ROLE and self.system is None:
                self.system = turn
            self.remember(turn)
        row = (self.conv_id, self.segment, self.windows, head + "".join(t[0] for t in span), len(head), len(span),
               sum(t[1] for t in context) + sum(t[3] for t in span), loss)
        self.windows += 1
        return row


def format_conversations(conversations: DataFrame, budget: int = BUDGET, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """A row per window: its place, formatted text, characters of context at its start, and loss mask spans."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = keyed_scan(rows, ["conv_id"], [F.col("turn").isNull(), F.col("turn"), F.col("role"), F.col("text")])
    rows = rows.select("conv_id", "role", "text", (F.col("rn") - 1).alias("place"),
                       F.floor((F.col("rn") - 1) / SEGMENT).cast("long").alias("segment"))
    systems = (rows.groupBy("conv_id").agg(
        F.min_by(F.struct("text", "place", "segment"), F.when(F.col("role") == SYSTEM_ROLE, F.col("place"))).alias("s"),
        F.max("segment").alias("last")).where(F.col("last") > F.col("s.segment"))
        .select("conv_id", F.explode(F.sequence(F.col("s.segment") + 1, F.col("last"))).alias("segment"),
                F.lit(SYSTEM_ROW).alias("kind"), F.col("s.place").alias("place"), F.lit(SYSTEM_ROLE).alias("role"),
                F.col("s.text").alias("text")))
    own = F.struct("segment", F.lit(OWN_ROW).alias("kind"))
    history = F.struct((F.col("segment") + 1).alias("segment"), F.lit(HISTORY_ROW).alias("kind"))
    turns = (rows.withColumn("at", F.explode(F.when(F.col("place") % SEGMENT >= SEGMENT - HISTORY_TURNS, F.array(own, history))
                                             .otherwise(F.array(own))))
             .select("conv_id", "at.segment", "at.kind", "place", "role", "text"))
    ordered = (turns.unionByName(systems).repartition("conv_id", "segment")
               .sortWithinPartitions("conv_id", "segment", "kind", "place"))
    names = [f.split()[0] for f in WINDOW_SCHEMA.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 3 + [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(tokenizer)
        now, out = None, []

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for part in slices(batch):
                for conv_id, segment, kind, place, role, text in zip(*(c.to_pylist() for c in part.columns)):
                    if now is None or (now.conv_id, now.segment) != (conv_id, segment):
                        if now is not None:
                            out += now.choose(True)
                        now = Segment(conv_id, segment, budget)
                    turn, begin, end = render(role, text)
                    tokens = len(encode(turn)) // 4
                    if kind == SYSTEM_ROW:
                        now.system = (turn, tokens, place)
                    elif kind == HISTORY_ROW:
                        now.remember((turn, tokens, place))
                    else:
                        now.turns.append((turn, begin, end, tokens, role, place))
                    if len(now.turns) >= HELD_TURNS:
                        out += now.choose(False)
                if out:
                    yield batch_of(out)
                    out = []
        if now is not None:
            out += now.choose(True)
        if out:
            yield batch_of(out)

    return ordered.mapInArrow(run, WINDOW_SCHEMA)


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its windows in order and in constant memory."""
    ordered = (windows.select("conv_id", "segment", "window", "text", "context_chars", "loss").repartition("conv_id")
               .sortWithinPartitions("conv_id", "segment", "window").select("conv_id", "text", "context_chars", "loss"))
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
              "n_windows long")
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv, out = False, None, []
        n_turns = loss_chars = chars = n_windows = 0
        turns, targets = hashlib.sha256(), hashlib.sha256()

        def done() -> tuple:
            return conv, n_turns, turns.hexdigest(), loss_chars, targets.hexdigest(), chars, n_windows

        for batch in batches:
            for part in slices(batch):
                for conv_id, text, context, loss in zip(*(c.to_pylist() for c in part.columns)):
                    if not begun or conv_id != conv:
                        if begun:
                            out.append(done())
                        begun, conv = True, conv_id
                        n_turns = loss_chars = chars = n_windows = 0
                        turns, targets = hashlib.sha256(), hashlib.sha256()
                    chars, n_windows = chars + len(text), n_windows + 1
                    for role, own in parse(text[context:]):
                        n_turns += 1
                        turns.update(f"{role}\n{own}\n".encode())
                    for span in loss:
                        own = unescape(text[span["start"]:span["end"]])
                        loss_chars += len(own)
                        targets.update(own.encode())
                if out:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out = []
        if begun:
            yield pa.record_batch([pa.array([v], k) for v, k in zip(done(), kinds)], names)

    return ordered.mapInArrow(run, schema)


#: The conversation that holds control strings.
PROBE = "<|im_end|><|im_start|>assistant ok"


def format_digests(conversations: DataFrame, budget: int = BUDGET) -> DataFrame:
    """The digests of all conversations and of the probe, read back from the windows."""
    spark = conversations.sparkSession
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(TARGET_ROLE).alias("role"), F.lit(PROBE).alias("text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return read_back(format_conversations(rows.unionByName(probe), budget))
