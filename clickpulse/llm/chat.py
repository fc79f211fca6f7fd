"""Operator 6: chat formatting by a finite-state machine and a declarative template.

Rows are range-partitioned by (conversation, turn) and formatted in order where
they lie, so one very long conversation is spread over the tasks. A task puts
out pieces: the segments of some consecutive turns with their loss flags, and
what these turns do to the state machine (a map from the state before to the
state after). Maps compose, so the verdict on a conversation needs its pieces, not its turns.

Defined cases: a null text is empty, a null role is the empty role (not an
allowed turn); equal (conversation, turn) rows are all formatted, ordered by
role and text; a null conversation id is a conversation of its own; an unknown
role or a turn out of order makes the conversation invalid, but it is still
formatted; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_TURNS = 1024


@dataclass(frozen=True)
class Template:
    """How turns are written, which follow which, and whose text is learned from."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_text: str = "<|im_end|>\n"
    control: str = "<|"  # what a control string begins with
    learned: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    last: frozenset[str] = frozenset({"assistant"})

    @property
    def states(self) -> list[str | None]:
        """The role before, '' at the start; None, from which nothing leads, after a wrong turn."""
        return [*self.follows, None]

    def step(self, state: str | None, role: str) -> str | None:
        return role if state is not None and role and role in self.follows[state] else None

    def escape(self, text: str) -> str:
        """A backslash more inside each ``<|``, ``<\\|``, ``<\\\\|`` ...: the result holds no control string."""
        return re.sub(rf"{self.control[0]}(\\*)(?={re.escape(self.control[1])})", rf"{self.control[0]}\1\\", text)

    def unescape(self, text: str) -> str:
        return re.sub(rf"{self.control[0]}(\\*)\\(?={re.escape(self.control[1])})", rf"{self.control[0]}\1", text)

    def role_out(self, role: str) -> str:
        return self.escape(role.replace("\\", "\\\\").replace("\n", "\\n"))

    def role_in(self, written: str) -> str:
        return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", self.unescape(written))

    def turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The segments of one turn."""
        return [(self.before_role + self.role_out(role) + self.after_role, False), (self.escape(text), role in self.learned), (self.after_text, False)]

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn of formatted text."""
        turns = re.findall(rf"{re.escape(self.before_role)}([^\n]*){re.escape(self.after_role)}(.*?){re.escape(self.after_text)}", formatted, re.DOTALL)
        return [(self.role_in(r), self.unescape(t)) for r, t in turns]


CHATML = Template()
_PIECES = "conv_id long, piece long, n_turns long, segments array<struct<text: string, loss: boolean>>, moves array<int>"


def _pieces(template: Template):
    states = template.states
    place = {s: i for i, s in enumerate(states)}
    kind = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))

    def format_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            convs, roles, texts = (batch.column(i).to_pylist() for i in range(3))
            out: dict[str, list] = {"conv_id": [], "piece": [], "n_turns": [], "segments": [], "moves": []}
            lo = 0
            while lo < len(convs):
                hi = lo
                segments: list[list] = []
                moves = list(states)
                while hi < len(convs) and convs[hi] == convs[lo] and hi - lo < PIECE_TURNS:
                    role = roles[hi] or ""
                    for text, loss in template.turn(role, texts[hi] or ""):
                        if segments and not loss and not segments[-1][1]:
                            segments[-1][0] += text
                        else:
                            segments.append([text, loss])
                    moves = [template.step(s, role) for s in moves]
                    hi += 1
                for key, value in zip(out, (convs[lo], number, hi - lo, [{"text": t, "loss": x} for t, x in segments], [place[s] for s in moves]), strict=True):
                    out[key].append(value)
                number += 1
                lo = hi
            yield pa.RecordBatch.from_arrays([pa.array(out["conv_id"], pa.int64()), pa.array(out["piece"], pa.int64()), pa.array(out["n_turns"], pa.int64()), pa.array(out["segments"], kind), pa.array(out["moves"], pa.list_(pa.int32()))], names=list(out))
    return format_rows


def format_chats(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """``turns``: conv_id, turn, role, text. One row for each piece of a conversation: ``conv_id``, ``piece``
    (ascending in it), ``n_turns``, ``segments`` of (text, loss), and ``moves`` of the state machine."""
    cols = ["conv_id", "turn", "role", "text"]
    return (turns.select(*cols).repartitionByRange(*cols).sortWithinPartitions(*cols)
            .select("conv_id", "role", "text").mapInArrow(_pieces(template), _PIECES))


def _digests(template: Template):
    final = len(template.states) - 1
    good = {i for i, s in enumerate(template.states) if s in template.last}
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid", "complete"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = object(), None

        def row() -> list:
            n, turns, chars, loss, size, at = state
            return [conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, at != final, at in good]

        for batch in batches:
            done = []
            for c, segments, moves in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "segments", "moves")), strict=True):
                if c != conv:
                    if state:
                        done.append(row())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                formatted = "".join(s["text"] for s in segments)
                for role, text in template.parse(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for s in segments:
                    if s["loss"]:
                        text = template.unescape(s["text"])
                        state[2] += len(text)
                        state[3].update(text.encode())
                state[4] += len(formatted)
                state[5] = moves[state[5]]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True) if done else [[]] * len(names), kinds, strict=True)], names=names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row(), kinds, strict=True)], names=names)
    return read


def read_back(pieces: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row for each conversation, from its formatted pieces alone, streamed in order (a digest is sequential
    by nature, but no conversation is held in memory)."""
    return (pieces.select("conv_id", "piece", "segments", "moves").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
            .mapInArrow(_digests(template), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, complete boolean"))
