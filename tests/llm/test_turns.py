"""Operator 13: the search against a plain dynamic programme, long and cut conversations, awkward rows."""

import hashlib
import random
import re

import pytest

from clickpulse.llm import turns as C
from tests.llm.helpers import with_clashes

ROWS = "conv_id LONG, turn LONG, role STRING, text STRING"


def plain(rows):
    """(cost, edits) by the least (cost, edits) of every state, row by row."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    write = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def relax(best):
        for _ in range(3):
            for q, (c, e) in list(best.items()):
                best[write[q]] = min(best.get(write[q], (c + 3, e + "I")), (c + 3, e + "I"))
        return best

    for initial, what in rows:
        new = {}
        for q, (c, e) in relax(best).items():
            moves = [(q, 4, "D")]
            if what <= C.TRUNCATED:
                moves.append((write[q], 3 + 3 * what, "R"))
                if (q, initial) in step:
                    moves.append((step[q, initial], 3 * what, "K"))
            for to, cost, edit in moves:
                new[to] = min(new.get(to, (c + cost, e + edit)), (c + cost, e + edit))
        best = new
    best = relax(best)
    return min(best[q] for q in ("", "a") if q in best)


def model(rows):
    """What the query returns for one conversation's rows (turn, role, text), nulls replaced."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, kinds = set(), []
    for _, role, text in rows:
        kinds.append(C.fault(text, (role, text) in seen))
        seen.add((role, text))
    cost, edits = plain([(r[1][:1], k) for r, k in zip(rows, kinds)])
    out, state, i = [], "", 0
    for e in edits:
        if e == "I":
            role, text = ("assistant" if state == "u" else "user"), ""
        else:
            _, role, text = rows[i]
            i += 1
            if e == "D":
                continue
            if e == "R":
                role = "assistant" if state == "u" else "user"
        out.append(f"{role}:{text}")
        state = role[:1]
    assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in out))
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(kinds.count(k) for k in (C.BLANK, C.DUPLICATE, C.TRUNCATED)), illegal, cost, edits, hashlib.sha256("\n".join(out).encode()).hexdigest())


def random_rows(rng, n, texts):
    return [(t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), rng.choice(texts)) for t in range(n)]


def test_search_finds_the_least_of_the_cheapest_repairs():
    rng = random.Random(5)
    for _ in range(3000):
        rows = [(rng.choice("uausat "), rng.choice([C.GOOD, C.GOOD, C.GOOD, C.TRUNCATED, C.DUPLICATE, C.BLANK])) for _ in range(rng.randrange(9))]
        assert C.search(rows) == plain(rows), rows


def test_ties_are_broken_by_the_edits_initials():
    assert C.search([("u", C.GOOD)]) == (3, "KI")
    assert C.search([("a", C.GOOD)]) == (3, "IK")           # insert and keep, not delete
    assert C.search([("u", C.GOOD), ("u", C.GOOD)]) == (3, "KR")
    assert C.search([("u", C.TRUNCATED)]) == (4, "D")
    assert C.search([]) == (0, "")
    assert C.search([("s", C.GOOD)]) == (4, "D")


def expected(spark_rows):
    convs = {}
    for c, t, r, x in spark_rows:
        convs.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    return sorted(((c, *model(rows)) for c, rows in convs.items()), key=repr)


def got(df):
    return sorted((tuple(r) for r in C.read_back(C.repair(df)).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=repr)


def awkward():
    rng = random.Random(7)
    texts = ["Yes.", "No!", "and then", "Why?", " ", "", "\n", "é.", "x" * 100_000 + ".", "ok\t", "a."]
    rows = [(c, t, r, x) for c in range(60) for t, r, x in random_rows(rng, rng.randrange(1, 12), texts)]
    rows += [(60, t, r, f"{i} {x}") for i, (t, r, x) in enumerate(random_rows(rng, 400, texts[:4]))]                # long, mostly distinct
    rows += [(61, t, r, x) for t, r, x in random_rows(rng, 300, texts)]                                             # long, mostly repeated
    rows += [(62, 5, "user", "same.")] * 90                                                                        # one row, many times
    rows += [(63, None, None, None), (63, None, "user", "a."), (63, 2, "assistant", "b."), (63, 7, "user", "c.")]
    rows += [(None, 0, "user", "q."), (None, 1, "assistant", "r.")]
    rows += [(64, None, "user", "only null turns.")]
    rows += [(65, t, "ua"[t % 2] == "u" and "user" or "assistant", f"{t}.") for t in range(3000)]                   # very long and right
    return rows


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_conversations_against_the_plain_version(spark, parts):
    rows = awkward()
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # so that edges of partitions cut conversations
    try:
        assert got(with_clashes(spark.createDataFrame(rows, ROWS))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_pieces_hold_the_repaired_turns(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(3000)] + [(2, 0, "assistant", "hm.")]
    pieces = C.repair(spark.createDataFrame(rows, ROWS)).collect()
    long = sorted((p for p in pieces if p.conv_id == 1), key=lambda p: p.piece)
    assert len(long) > 1 and [t.text for p in long for t in p.turns] == [f"{t}." for t in range(3000)]
    assert [(t.role, t.text) for p in pieces if p.conv_id == 2 for t in p.turns] == [("user", ""), ("assistant", "hm.")]
    assert C.repair(spark.createDataFrame([], ROWS)).count() == 0


def test_damage_by_checksum(spark):
    import zlib
    rows = [(c, t, r, x) for c in (None, 3, 4) for t in [None, *range(60)] for r, x in [("assistant", "Wait. What?!"), (None, None)]]
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if kind:
            want += [(c, t, "user" if kind == 4 else r, "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x)] * (1 + (kind == 3))
    assert sorted(map(tuple, C.damage(spark.createDataFrame(rows, ROWS)).collect()), key=repr) == sorted(want, key=repr)
