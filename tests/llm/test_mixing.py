"""Operator 12: exact slots, ranks and words against plain versions; awkward tables."""

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from clickpulse.llm import mixing
from tests.llm.helpers import DOCS, docs, with_clashes, words


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(most * sizes[s] for s in fixed)
        share = {s: Fraction(left * weight[s], sum(weight[x] for x in free)) for s in free}
        above = {s for s in free if share[s] > most * sizes[s]}
        if not above:
            return {s: share.get(s, Fraction(most * sizes[s])) for s in order}
        fixed |= above


def plain_taken(rows, block):
    """Words taken of each row (by position) when each source's shuffled stream is repeated up to its target."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(words(text))
    targets = plain_targets(sizes) if rows else {}
    taken = [0] * len(rows)
    name = lambda i, t: str(i) if i is not None else "null:" + hashlib.md5((t or "").encode()).hexdigest()
    for source, target in targets.items():
        own = sorted((hashlib.md5(f"{name(d, t)}:0".encode()).hexdigest(), (d is not None, d or 0), len(words(t)), k) for k, (d, t, s) in enumerate(rows) if s == source)
        stream = [k for *_, n, k in own for _ in range(n)]
        want = int(target + Fraction(1, 2))
        for i in range(want):
            taken[stream[i % len(stream)]] += 1
    return taken, targets


def sample(n=120):
    out = []
    for i in range(n):
        out.append((i, " ".join(["w"] * (i * 37 % 50)) if i % 11 else None, [None, "a", "b", "é", "B", "tiny"][i % 6 if i % 6 < 5 or i == 5 else 1]))
    out += [(500, "x " * 5000, "a"), (501, "", "empty"), (None, "one two", "a"), (None, "one two", "a"), (7, "again and again", "b"), (7, "again and again", "b")]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], DOCS)


def test_words_taken_equal_the_plain_version(spark):
    rows = sample()
    want, targets = plain_taken(rows, 64)
    m = mixing.mix(with_clashes(frame(spark, rows)), block_words=64)
    got = m.taken().collect()
    key = lambda d, s, n: (repr(d), repr(s), n)
    assert Counter((key(r.id, r.source, r.size), r.taken) for r in got) == Counter((key(d, s, len(words(t))), k) for (d, t, s), k in zip(rows, want))
    for r in m.sources.collect():
        assert abs(r.target - float(targets[r.source])) < 1e-6 and r.want == int(targets[r.source] + Fraction(1, 2))
    assert all(r.taken <= 3 * r.size for r in got)
    # the same rows in other partitions: the same mix
    again = mixing.mix(frame(spark, rows[::-1]).repartition(5), block_words=64)
    cols = ["slot", "at", "sid", "epoch", "block", "id", "first", "words"]
    assert sorted(map(str, m.pieces.select(*cols).collect())) == sorted(map(str, again.pieces.select(*cols).collect()))


def test_schedule_has_every_slot_once_and_ranks_in_time_order(spark):
    sources = spark.createDataFrame([(0, 0, 700, 200, 13), (1, 700, 1, 1, 5), (2, 701, 35_000, 40_000, 0), (3, 35_701, 0, 0, 0)], "sid long, first_slot long, slots long, blocks long, rest long")
    out = mixing.schedule(sources, 64).persist()
    assert out.count() == out.select("slot").distinct().count() == 35_701
    assert {r.sid: r["count"] for r in out.groupBy("sid").count().collect()} == {0: 700, 1: 1, 2: 35_000}
    ranked = out.withColumn("plain", F.expr("row_number() OVER (PARTITION BY sid ORDER BY slot) - 1"))
    assert ranked.where("plain <> rank").count() == 0
    # low discrepancy: any stretch of the schedule holds a source's share of it, up to a few slots
    marks = {s: sorted(r.slot for r in out.where(f"sid = {s}").select("slot").collect()) for s in (0, 2)}
    last = 1 << 16
    for s, slots in marks.items():
        for k in range(1, 20):
            inside = sum(x < k * last // 20 for x in slots)
            assert abs(inside - len(slots) * k / 20) <= 17
    rooms = {r.rank: r.room for r in out.where("sid = 0").collect()}
    assert rooms[699] == 13 and set(rooms[r] for r in range(699)) == {64}


def test_texts_are_the_words_of_the_pieces(spark):
    rows = [(i, " ".join(f"{i}.{k}" for k in range(40 + i)), "ab"[i % 2]) for i in range(12)]
    m = mixing.mix(frame(spark, rows), block_words=32, texts=True)
    out = m.texts().orderBy("slot", "at").collect()
    assert sum(len(r.text.split()) for r in out) == m.pieces.agg(F.sum("words")).first()[0]
    per_slot = defaultdict(int)
    for r in out:
        per_slot[r.slot] += len(r.text.split())
        assert all(w.startswith(f"{r.id}.") for w in r.text.split())
    assert max(per_slot.values()) <= 32
    used = Counter(w for r in out for w in r.text.split())
    taken = {r.id: r.taken for r in m.taken().collect()}
    for i, _, _ in rows:
        assert sum(n for w, n in used.items() if w.startswith(f"{i}.")) == taken[i]


def test_target_stops_at_three_times_a_source_and_the_excess_is_reshared(spark):
    rows = [(0, "w " * 10, "a"), (1, "w " * 10, "b"), (2, "w " * 10, "c"), (3, "w " * 1000, "d")]
    m = mixing.mix(frame(spark, rows), block_words=16)
    assert [(r.source, r.target, r.want) for r in m.sources.orderBy("sid").collect()] == [("a", 30.0, 30), ("b", 30.0, 30), ("c", 30.0, 30), ("d", 940.0, 940)]
    assert sorted((r.id, r.taken) for r in m.taken().collect()) == [(0, 30), (1, 30), (2, 30), (3, 940)]


def test_empty_tables_and_texts(spark):
    m = mixing.mix(docs(spark, []))
    assert m.taken().count() == m.pieces.count() == m.sources.count() == 0
    m = mixing.mix(docs(spark, [None, "", " \n "]))
    assert [(r.target, r.want, r.slots) for r in m.sources.collect()] == [(0.0, 0, 0)] * 3
    assert [r.taken for r in m.taken().collect()] == [0, 0, 0]
