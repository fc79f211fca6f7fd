"""Operator 13: repair of a conversation's structure by iterative-deepening A*.

A conversation's rows, in the order of their turns, are edited at least cost so
that their roles read ``(s?(ua)+)?``: nothing, or an optional system row, then user and
assistant rows in turn. Keep costs 0, Rerole to user or assistant 3, Insert of an empty user or
assistant row 3, Delete 4; blank and repeated rows must be deleted, a row that is cut off adds 3 unless deleted.
Of the cheapest repairs the one whose edits' initials are least in ASCII order is taken.

``search`` is the method: depth-first in the order D, I, K, R under a cost bound that rises
to the least cost that was out of reach, with a table of failed states that holds what
each at least needs; the first accepting path is the answer.

Rows are range-partitioned by (conversation, turn, role, text) and searched where they lie. A
conversation longer than ``SEGMENT_ROWS``, or one that a partition's edge may cut, is searched by segment, from every
state of the role pattern to every state it can end in; the best paths are then joined segment by segment
(of equally cheap paths to one state neither is the other's prefix, so the least stays the least
whatever follows). What all surviving paths share is put out at once, so
a long conversation streams through in pieces. Whether a row repeats an earlier one comes from the first turn
of each (conversation, role, text), an aggregate that is joined back.

Defined cases: null roles and texts are one space; null turns come first; rows of one turn are ordered by role and
text; a null conversation id is a conversation of its own; an unknown role is its first character (kept only where that
fits), an empty one fits nowhere; equal rows are duplicates; an empty table gives an empty result. Only the named columns
are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
SEGMENT_ROWS, PIECE_EDITS = 32, 512
WHITE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}

#: States of the pattern: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = frozenset({START, ASSISTANT})
_STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The only role that may be written (rerole, insert) after each state.
_WRITTEN = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}

#: By state: others, and what a path from each of them costs at most above the best path from this one (write a row
#: to change state, delete the system row that may no longer be kept). A dearer path to this state is never the cheapest.
_STANDS_FOR = {START: {ASSISTANT: DELETE, USER: DELETE + INSERT}, SYSTEM: {ASSISTANT: 0, START: 0, USER: INSERT},
               USER: {ASSISTANT: INSERT, START: INSERT, SYSTEM: INSERT}, ASSISTANT: {START: 0, USER: INSERT}}

GOOD, TRUNCATED, DUPLICATE, BLANK = range(4)


def fault(text: str, repeated: bool) -> int:
    """A row's first fault."""
    ink = text.rstrip(WHITE)
    if not ink:
        return BLANK
    return DUPLICATE if repeated else GOOD if ink[-1] in ".!?" else TRUNCATED


def search(rows: list[tuple[str, int]], start: int = START, goals: frozenset[int] = ACCEPTING) -> tuple[int, str] | None:
    """(cost, edits) of the least of the cheapest paths from ``start`` to a state of ``goals`` over all ``rows`` (initial, fault);
    None if there is none."""
    n = len(rows)
    least = [0] * (n + 1)  # what the faults of the rows left cost in any case
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (DELETE if rows[i][1] >= DUPLICATE else min(DELETE, CUT_OFF) if rows[i][1] == TRUNCATED else 0)
    if goals <= {START, SYSTEM}:  # nothing is written: all rows go, but for the one that leads to SYSTEM
        least = [max(x, DELETE * (n - i - (start not in goals))) for i, x in enumerate(least)]
    needs: dict[tuple[int, int], float] = {}  # of failed states: what is needed from there, at least
    path: list[str] = []

    def visit(i: int, state: int, budget: float) -> float:
        """0 if the rest can be done within ``budget`` (then ``path`` holds it), else what it needs at least."""
        if i == n and state in goals:
            return 0
        need = needs.get((i, state), least[i])
        if need > budget:
            return need
        found = float("inf")
        edits = []
        if i < n:
            initial, what = rows[i]
            edits.append(("D", DELETE, i + 1, state))
        edits.append(("I", INSERT, i, _WRITTEN[state][1]))
        if i < n and what <= TRUNCATED:
            extra = CUT_OFF if what == TRUNCATED else 0
            if (state, initial) in _STEP:
                edits.append(("K", KEEP + extra, i + 1, _STEP[state, initial]))
            edits.append(("R", REROLE + extra, i + 1, _WRITTEN[state][1]))
        for edit, cost, j, after in edits:
            if cost > budget:
                found = min(found, cost + needs.get((j, after), least[j]))
                continue
            path.append(edit)
            rest = visit(j, after, budget - cost)
            if rest == 0:
                return 0
            path.pop()
            found = min(found, cost + rest)
        needs[i, state] = found
        return found

    # No repair costs more than deleting all rows and then writing the way to a goal.
    most = DELETE * n + 2 * INSERT
    bound: float = least[0]
    while bound <= most:
        path.clear()
        rest = visit(0, start, bound)
        if rest == 0:
            return _cost(rows, path), "".join(path)
        bound = rest
    return None


def _cost(rows: list[tuple[str, int]], edits: list[str]) -> int:
    total = i = 0
    for e in edits:
        total += {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}[e]
        if e != "I":
            total += CUT_OFF if e != "D" and rows[i][1] == TRUNCATED else 0
            i += 1
    return total


_ROWS = "array<struct<role: string, text: string, fault: int>>"
_SEGMENTS = (f"conv_id long, seq long, rows {_ROWS}, illegal long, first string, last string, low long, high long, turns long, "
             "first_turn long, last_turn long, whole boolean, paths array<struct<start: int, end: int, cost: long, edits: string>>")
_PIECES = "conv_id long, piece long, edits string, turns array<struct<role: string, text: string>>, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
#: States that a state can lead to.
_AFTER = {START: (START, SYSTEM, USER, ASSISTANT), SYSTEM: (SYSTEM, USER, ASSISTANT), USER: (USER, ASSISTANT), ASSISTANT: (USER, ASSISTANT)}
_PATH = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])
_ROW = pa.struct([("role", pa.string()), ("text", pa.string()), ("fault", pa.int32())])
_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_SEGMENT_SCHEMA = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("rows", pa.list_(_ROW)), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
                             ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("whole", pa.bool_()), ("paths", pa.list_(_PATH))])
_PIECE_SCHEMA = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("edits", pa.string()), ("turns", pa.list_(_TURN)),
                           *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))])


def _segment(conv: int | None, seq: int, rows: list[tuple], whole: bool) -> dict:
    """``rows``: (role, text, fault, turn). A whole conversation has one path, a part of one has those between all states."""
    initials = [r[0][:1] for r in rows]
    short = list(zip(initials, (r[2] for r in rows), strict=True))
    if whole:
        paths = [(START, ASSISTANT, *search(short))]
    else:
        paths = [(p, q, *found) for p, ends in _AFTER.items() for q in ends if (found := search(short, p, frozenset({q})))]
    turns = [r[3] for r in rows if r[3] is not None]
    return {"conv_id": conv, "seq": seq, "rows": [{"role": r, "text": t, "fault": f} for r, t, f, _ in rows],
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)), "first": initials[0], "last": initials[-1],
            "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "turns": len(set(turns)),
            "first_turn": rows[0][3], "last_turn": rows[-1][3], "whole": whole,
            "paths": [{"start": p, "end": q, "cost": c, "edits": e} for p, q, c, e in paths]}


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order (conv_id, turn, role, text, copies, first) to segments."""
    seq = TaskContext.get().partitionId() << 33
    conv, rows, parted, out = object(), [], True, []
    edge = True  # the partition's first conversation may have begun in the one before

    for batch in batches:
        for c, turn, role, text, copies, first in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if c != conv:
                if rows:
                    out.append(_segment(conv, seq, rows, not parted))
                    seq += 1
                    edge = False
                conv, rows, parted = c, [], edge
            for k in range(copies):
                if len(rows) == SEGMENT_ROWS:
                    parted = True
                    out.append(_segment(conv, seq, rows, False))
                    seq += 1
                    rows = []
                rows.append((role, text, fault(text, not first or k > 0), turn))
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, _SEGMENT_SCHEMA)
                    out = []
    if rows:
        out.append(_segment(conv, seq, rows, False))
    yield pa.RecordBatch.from_pylist(out, _SEGMENT_SCHEMA)


class _Joined:
    """One conversation while its segments pass: surviving paths by state, rows they have not agreed on, and the counts."""

    def __init__(self, conv: int | None):
        self.conv, self.piece = conv, 0
        self.best: dict[int, tuple[int, str]] = {START: (0, "")}
        self.rows: list[dict] = []
        self.state = START
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.last = None
        self.turn: tuple | None = None
        self.distinct = 0

    def add(self, s: dict) -> Iterator[dict]:
        rows = s["rows"]
        for name, f in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED)):
            self.count[name] += sum(r["fault"] == f for r in rows)
        self.count["illegal"] += s["illegal"] + (self.last is not None and self.last + s["first"] not in LEGAL)
        self.last = s["last"]
        self.distinct += s["turns"] - (s["first_turn"] is not None and self.turn == (s["first_turn"],))
        self.turn = (s["last_turn"],)
        self.low = s["low"] if self.low is None else self.low
        self.high = s["high"] if s["high"] is not None else self.high
        self.rows += rows
        best: dict[int, tuple[int, str]] = {}
        for path in s["paths"]:
            if path["start"] in self.best:
                cost, edits = self.best[path["start"]]
                here = (cost + path["cost"], edits + path["edits"])
                best[path["end"]] = min(best.get(path["end"], here), here)
        self.best = {q: found for q, found in best.items() if all(found[0] <= best[p][0] + more for p, more in _STANDS_FOR[q].items() if p in best)}
        agreed = os.path.commonprefix([e for _, e in self.best.values()])
        if len(agreed) >= PIECE_EDITS:
            self.best = {q: (c, e[len(agreed):]) for q, (c, e) in self.best.items()}
            yield self._put(agreed)

    def _put(self, edits: str) -> dict:
        turns, i = [], 0
        for e in edits:
            if e == "I":
                role, self.state = _WRITTEN[self.state]
                turns.append({"role": role, "text": ""})
                continue
            row, i = self.rows[i], i + 1
            if e == "K":
                self.state = _STEP[self.state, row["role"][:1]]
                turns.append({"role": row["role"], "text": row["text"]})
            elif e == "R":
                role, self.state = _WRITTEN[self.state]
                turns.append({"role": role, "text": row["text"]})
        self.rows = self.rows[i:]
        self.piece += 1
        return {"conv_id": self.conv, "piece": self.piece - 1, "edits": edits, "turns": turns, "gaps": 0, "cost": 0, **dict.fromkeys(self.count, 0)}

    def end(self) -> dict:
        cost, edits = min(self.best[q] for q in ACCEPTING if q in self.best)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return self._put(edits) | self.count | {"gaps": gaps, "cost": cost}


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order to pieces."""
    now: _Joined | None = None
    for batch in batches:
        out: list[dict] = []
        for s in batch.to_pylist():
            if now is None or s["conv_id"] != now.conv:
                if now:
                    out.append(now.end())
                now = _Joined(s["conv_id"])
            out += now.add(s)
        yield pa.RecordBatch.from_pylist(out, _PIECE_SCHEMA)
    if now:
        yield pa.RecordBatch.from_pylist([now.end()], _PIECE_SCHEMA)


def repair(turns: DataFrame) -> DataFrame:
    """``turns``: conv_id, turn, role, text. The repaired conversations in pieces (one, unless a conversation is very long):
    ``conv_id``, ``piece`` (ascending in it), ``edits`` (initials), ``turns`` (role and text, repaired), and, with the last piece, ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` and ``cost`` of the conversation."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    order = ["conv_id", "turn", "role", "text"]
    said = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    counted = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("copies")).withColumn("said", said)
    when = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    firsts = counted.groupBy("said").agg(F.min(when).alias("begin"))
    ordered = (counted.join(firsts, "said").select(*order, "copies", F.col("turn").eqNullSafe(F.col("begin.turn")).alias("first"))
               .repartitionByRange(*order).sortWithinPartitions(*order))
    segments = ordered.mapInArrow(_segments, _SEGMENTS)
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(_join, _PIECES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in names), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    conv, state = object(), None

    def row() -> dict:
        return {"conv_id": conv, **state[0], "audit": "".join(state[1]), "repaired_sha256": state[2].hexdigest()}

    for batch in batches:
        out = []
        for p in batch.to_pylist():
            if p["conv_id"] != conv:
                if state:
                    out.append(row())
                conv, state = p["conv_id"], [dict.fromkeys(names, 0), [], hashlib.sha256(), False]
            for c in names:
                state[0][c] += p[c]
            state[1].append(p["edits"])
            for t in p["turns"]:
                state[2].update(("\n" * state[3] + f"{t['role']}:{t['text']}").encode())
                state[3] = True
        yield pa.RecordBatch.from_pylist(out, schema)
    if state:
        yield pa.RecordBatch.from_pylist([row()], schema)


def read_back(pieces: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair``'s pieces, streamed in order: the counts, ``audit`` (all edits) and ``repaired_sha256``
    of the repaired ``role:text``, joined by line breaks. The audit and the digest of one conversation are sequential by nature; the digest holds no text."""
    return (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
            .mapInArrow(_digests, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"))


def damage(turns: DataFrame) -> DataFrame:
    """The rows damaged by the crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its full stops, exclamation
    and question marks, 3 repeats it, 4 makes its role user; null values are one space (a null conv_id or turn stays null in its column)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select("conv_id", "turn", F.expr("IF(kind = 4, 'user', role)").alias("role"),
                       F.expr("CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END").alias("text"),
                       F.explode(F.expr("IF(kind = 3, array(0, 1), array(0))")).alias("copy")).drop("copy")
