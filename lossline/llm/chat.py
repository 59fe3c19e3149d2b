"""Chat formatting by a finite-state machine over roles, and reading back.

A ``Template`` declares the marks around each role's turns, which roles' texts
count for the loss, and the machine: its states and the roles that each state
lets follow. The formatter streams the turns of a conversation in order, runs the
machine over their roles and emits text segments with a loss flag each: marks
never count, a text counts if its role does. Control strings inside texts are
escaped, so marks can't be forged and ``read_back`` recovers every turn from the
output alone.

One shuffle deals turns by conversation and sorts them there; a task holds one
Arrow batch of turns and one conversation's state, never a whole conversation.
(Its digests run over its turns in order, so one conversation is one stream,
however long.)

Defined cases: a null text is empty; a null role is the empty role; a role that
the template doesn't know, or that may not follow, is formatted all the same and
marked as a violation (an unknown one leaves the machine in the state ``other``);
turns sort by (turn, role, text), nulls first, so repeated rows are turns of their
own; rows with a null conv_id form one conversation with a null id; an empty table
gives no rows; further columns take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``turns`` by role; ``other`` is (before, between name and text, after) for all
    other roles; ``follow`` gives, for each state, the state that a role leads to."""

    begin: str
    turns: dict[str, Turn]
    other: tuple[str, str, str]
    controls: tuple[str, ...]
    follow: dict[str, dict[str, str]]
    final: tuple[str, ...]
    escape: str = "\\"

    def __post_init__(self) -> None:
        befores = [t.before for t in self.turns.values()] + [self.other[0]]
        for a in befores:
            if not a or sum(b.startswith(a) for b in befores) != 1:
                raise ValueError(f"the marks before turns don't tell roles apart: {a!r}")
        for mark in [t.after for t in self.turns.values()] + list(self.other[1:]):
            if not any(c in mark for c in self.controls):
                raise ValueError(f"a text could hold the mark {mark!r}")
            for c in self.controls:
                if any(c[i:] and mark.startswith(c[i:]) for i in range(1, len(c))):
                    raise ValueError(f"the end of a text and {mark!r} could form {c!r}")
        if any(len(c) < 2 or self.escape in c for c in self.controls):
            raise ValueError("control strings have two characters or more and don't hold the escape")

    def state_after(self, role: str) -> str:
        """The state a role leads to where it may follow (and after a violation)."""
        return next((s[role] for s in self.follow.values() if role in s), "other")

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """(next state, whether the role may follow)."""
        allowed = self.follow.get(state, {})
        return (allowed[role], True) if role in allowed else (self.state_after(role), False)


#: Marks of a well-known chat format; the role marks for other roles are our own.
INST = Template(
    begin="<s>",
    turns={"system": Turn("<<SYS>>\n", "\n<</SYS>>\n"), "user": Turn("[INST] ", " [/INST]"),
           "assistant": Turn(" ", "</s>", loss=True)},
    other=("[ROLE]", "[SAYS]", "[/ROLE]"),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[SAYS]", "[/ROLE]"),
    follow={"start": {"system": "instructed", "user": "asked"}, "instructed": {"user": "asked"},
            "asked": {"assistant": "answered"}, "answered": {"user": "asked"}, "other": {"user": "asked"}},
    final=("answered",),
)


class Marker:
    """Escapes texts and writes turns as (text, loss) segments."""

    def __init__(self, template: Template):
        self.t = template
        self.control = re.compile("|".join(re.escape(c) for c in sorted(template.controls, key=len, reverse=True)))
        self.escaped = re.compile(re.escape(template.escape) + "(" + re.escape(template.escape) + "?)")

    def escape(self, text: str) -> str:
        """Doubles the escape and puts one into each control string."""
        e = self.t.escape
        if e in text:
            text = text.replace(e, e + e)
        return self.control.sub(lambda m: m[0][0] + e + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(r"\1", text) if self.t.escape in text else text

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        turn = self.t.turns.get(role)
        if turn is None:
            before, between, after = self.t.other
            return [(before + self.escape(role) + between, False), (self.escape(text), False), (after, False)]
        return [(turn.before, False), (self.escape(text), turn.loss), (turn.after, False)]


class Reader:
    """Reads one conversation's formatted text, given piece by piece."""

    def __init__(self, marker: Marker):
        self.m, self.buffer, self.begun = marker, "", False

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """(role, text) of the turns that are whole now."""
        t = self.m.t
        self.buffer += text
        if not self.begun:
            if not self.buffer.startswith(t.begin):
                return
            self.buffer, self.begun = self.buffer[len(t.begin):], True
        at = 0
        while (found := self._turn(at)) is not None:
            role, text, at = found
            yield role, text
        self.buffer = self.buffer[at:]

    def _turn(self, at: int) -> tuple[str, str, int] | None:
        s, t = self.buffer, self.m.t
        for role, turn in t.turns.items():
            if s.startswith(turn.before, at):
                begin = at + len(turn.before)
                end = s.find(turn.after, begin)
                return None if end < 0 else (role, self.m.unescape(s[begin:end]), end + len(turn.after))
        before, between, after = t.other
        if s.startswith(before, at):
            begin = at + len(before)
            mid = s.find(between, begin)
            end = s.find(after, mid + len(between)) if mid >= 0 else -1
            if end >= 0:
                return self.m.unescape(s[begin:mid]), self.m.unescape(s[mid + len(between):end]), end + len(after)
        return None

    def end(self, conv: object) -> None:
        if self.buffer or not self.begun:
            raise ValueError(f"conversation {conv}: the formatted text can't be read back")


SEGMENTS = "conv_id long, segment long, text string, loss boolean, state string, follows boolean"


def format_turns(conversations: DataFrame, template: Template = INST) -> DataFrame:
    """Segments of ``conversations(conv_id, turn, role, text)``, in order within their
    conversation: ``segment`` counts from 0, ``state`` is the machine's state after
    the segment, ``follows`` whether its turn's role might follow the one before."""
    turns = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
                                  F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
             .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marker = Marker(template)
        begun, conv, state, n = False, None, "start", 0
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]

            def put(text: str, loss: bool, follows: bool) -> None:
                for col, v in zip(out, (conv, n, text, loss, state, follows)):
                    col.append(v)

            for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
                if not begun or c != conv:
                    begun, conv, state, n = True, c, "start", 0
                    put(template.begin, False, True)
                    n += 1
                state, follows = template.step(state, role)
                for text_out, loss in marker.segments(role, text):
                    put(text_out, loss, follows)
                    n += 1
            types = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["conv_id", "segment", "text", "loss", "state", "follows"])

    return arrow_map(turns.drop("turn"), run, SEGMENTS)


def read_back(segments: DataFrame, template: Template = INST, in_order: bool = False) -> DataFrame:
    """One row per conversation, from the formatted text alone: ``n_turns``,
    ``turns_sha256`` (role, newline, text, newline for each turn), ``loss_chars`` and
    ``loss_sha256`` (all text under the loss mask, unescaped), ``formatted_chars``,
    ``n_violations`` (of the machine) and ``complete`` (it ended in a final state).

    ``in_order``: the segments come straight from ``format_turns``, dealt and sorted;
    a table of segments that was written and read again is sorted first."""
    if not in_order:
        segments = segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_violations", "complete"]

    class Sums:
        def __init__(self, conv: int | None, marker: Marker):
            self.conv, self.reader = conv, Reader(marker)
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
            self.n = self.loss_chars = self.chars = self.violations = 0
            self.state = "start"

        def row(self) -> tuple:
            self.reader.end(self.conv)
            return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                    self.violations, self.state in template.final)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marker = Marker(template)
        now: Sums | None = None
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 8, types)],
                                              names=names)

        for batch in batches:
            done = []
            for c, text, loss in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "text", "loss"))):
                if now is None or c != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = Sums(c, marker)
                now.chars += len(text)
                if loss:
                    plain = marker.unescape(text)
                    now.loss_chars += len(plain)
                    now.loss.update(plain.encode("utf-8", "surrogatepass"))
                for role, said in now.reader.feed(text):
                    now.n += 1
                    now.turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    now.state, follows = template.step(now.state, role)
                    now.violations += not follows
            yield batch_of(done)
        if now is not None:
            yield batch_of([now.row()])

    return arrow_map(segments.select("conv_id", "text", "loss"), run,
                     "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                     "formatted_chars long, n_violations long, complete boolean")
