import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from hypothesis import given, settings
from hypothesis import strategies as st

from clickpulse.llm import registry, repeats
from tests.llm.helpers import docs, rows, with_clashes


def plain(items, window=repeats.WINDOW):
    """{index: (bytes, removed, spans, kept)} for (id, text) pairs."""
    raw = [(i, (t or "").encode()) for i, t in items]
    first = {}
    for i, b in raw:
        for k in range(len(b) - window + 1):
            if i is not None:
                first[b[k:k + window]] = min(first.get(b[k:k + window], i), i)
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if first.get(b[k:k + window], 1 << 70) < (1 << 65 if i is None else i):
                gone[k:k + window] = b"\1" * window
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, items, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in items], "doc_id LONG, text STRING, source STRING")
    out = repeats.remove_repeats(df, **kw).collect()
    return sorted(((r["rest"]["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in out), key=repr)


def test_against_plain_version(spark):
    rng = random.Random(5)
    prose = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    shared, other = prose(120), prose(49)
    texts = [prose(200) + shared + prose(30), shared, prose(10) + shared[5:80] + prose(100) + shared[60:], other + "x", "y" + other,
             "z" * 300, "z" * 70, "z" * 49, "", None, prose(3000), shared * 3]
    items = list(enumerate(texts)) + [(20, texts[0]), (20, texts[0]), (None, shared), (None, prose(60)), (5, "z" * 60)]
    items += [(30 + k, prose(20) + texts[10][k * 90:k * 90 + 400]) for k in range(25)]
    for chunk in (200, 1 << 22):
        assert run(spark, items, chunk_bytes=chunk) == plain(items), chunk


def test_small_alphabet_and_windows(spark):
    rng = random.Random(6)
    items = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 90)))) for i in range(60)]
    assert run(spark, items, window=8, gram=4, chunk_bytes=500) == plain(items, 8)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.binary(max_size=40)), min_size=1, max_size=8), st.integers(2, 20))
def test_radix_order_finds_equal_suffixes(parts, depth):
    data = b"".join(b.replace(b"", b"")[:40] + b"\0" * depth for _, b in parts)
    starts = np.arange(len(data) - depth + 1)
    ids = np.random.default_rng(0).integers(0, 9, len(starts))
    low = repeats.repeated_low(np.frombuffer(data, np.uint8), starts, ids, depth)
    best = {}
    for s in starts:
        best[data[s:s + depth]] = min(best.get(data[s:s + depth], 99), int(ids[s]))
    assert low.tolist() == [best[data[s:s + depth]] for s in starts]


def test_filter_keeps_columns_and_whole_characters(spark):
    rng = random.Random(7)
    shared = "é" + "".join(rng.choice("abcdefgh ") for _ in range(80))
    df = with_clashes(docs(spark, [shared, "à" + shared, None, ""]))
    out = repeats.without_repeats(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    assert dict(rows(out, "doc_id", "text"))[1] == "à" and dict(rows(out, "doc_id", "n_chars"))[1] == 1
    assert repeats.without_repeats(docs(spark, [])).collect() == []


def test_ranges_of_hashes_are_equal_shares():
    data = np.random.default_rng(8).integers(97, 123, 300_000).astype(np.uint8)
    found = repeats.runs(data, np.array([0, len(data)]), repeats.WINDOW, repeats.GRAM)
    shares = np.bincount((found.hash >> np.uint64(repeats.HASH_BITS - 6)).astype(np.int64), minlength=64) / len(found.hash)
    assert len(shares) == 64 and shares.max() < 1.3 / 64 and shares.min() > 0.7 / 64


def test_many_equal_rows_spread_over_chunks(spark):
    rng = random.Random(9)
    prose = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    same, shared = prose(900), prose(200)
    items = [(7, same + shared)] * 200 + [(None, same)] * 100 + [(3, shared), (8, prose(60) + shared), (9, None)] + [(20 + i, prose(500)) for i in range(20)]
    df = spark.createDataFrame([(i, t, "x") for i, t in items], "doc_id LONG, text STRING, source STRING")
    out, chunks = repeats.dealt(df, "doc_id", "text", 20_000)
    sizes = [r["count"] for r in out.groupBy("chunk").count().collect()]
    assert sum(sizes) == len(items) and chunks > 10 and max(sizes) < 60
    assert run(spark, items, chunk_bytes=20_000) == plain(items)


def test_null_texts_stay_null_in_the_filter(spark):
    out = repeats.without_repeats(docs(spark, [None, "", "text"], extra=[(9, None, "en", "s", 4)]))
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(0, None, None), (1, "", 0), (2, "text", 4), (9, None, 4)]


def test_null_ids_are_left_whole_by_the_query(spark, scratch):
    rng = random.Random(10)
    prose = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    shared = prose(120)
    items = [(None, shared), (4, shared), (None, prose(20) + shared), (9, prose(30) + shared), (2, prose(80)), (None, None)]
    docs(spark, [], extra=[(i, t, "en", "s", 0) for i, t in items]).write.parquet(f"{scratch}/documents.parquet")
    got = sorted((tuple(r) for r in registry.op2_repeated_bytes(spark, scratch).collect()), key=repr)
    numbered = plain([(i, t) for i, t in items if i is not None])
    whole = [(None, len(t or ""), 0, 0, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in items if i is None]
    assert got == sorted(numbered + whole, key=repr)


def test_steps_agree_whatever_the_order_of_a_chunks_rows():
    rng = random.Random(11)
    prose = lambda n: "".join(rng.choice("ab ") for _ in range(n))
    base = [prose(300) for _ in range(4)]
    items = [(i, prose(40).join(rng.choice(base)[rng.randrange(100):rng.randrange(200, 300)] for _ in range(3))) for i in range(40)]
    chunks = [items[:20], items[20:]]
    cfg = (repeats.WINDOW, repeats.GRAM, 2, True)

    def shuffled(k):
        some = rng.sample(chunks[k], len(chunks[k]))
        return pa.table({"chunk": pa.array([k] * len(some)), "id": pa.array([i for i, _ in some]), "text": pa.array([t for _, t in some]), "rest": pa.array([{"doc_id": i} for i, _ in some])})

    def meet(rows, step):
        return pa.concat_tables([step(rows.filter(pc.equal(rows.column("bucket"), b))) for b in set(rows.column("bucket").to_pylist())])

    own = lambda rows, k: rows.filter(pc.equal(rows.column("chunk"), k))
    held = meet(pa.concat_tables([repeats._send_anchors(cfg)(shuffled(k)) for k in range(2)]), repeats._meet_anchors)
    earlier = meet(pa.concat_tables([repeats._send_texts(cfg)(shuffled(k), own(held, k)) for k in range(2)]), repeats._meet_texts(cfg))
    out = [r for k in range(2) for r in repeats._cut(cfg)(shuffled(k), pa.concat_tables([own(held, k), own(earlier, k)])).to_pylist()]
    assert sorted(((r["rest"]["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in out), key=repr) == plain(items)
