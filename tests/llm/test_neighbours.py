import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clickpulse.llm import neighbours
from tests.llm.helpers import rows

VECTORS = "vec_id LONG, embedding ARRAY<FLOAT>, code INT"


def plain(items, k=5, every=50):
    sound = [(i, np.array(x, dtype=np.float32).astype(float)) for i, x in items
             if i is not None and x and all(c is not None and math.isfinite(c) for c in x) and any(x)]
    out = []
    for q, a in {i: a for i, a in reversed(sound) if i % every == 0}.items():
        near = sorted((-float(neighbours.exact_cosine(a[None], b[None])[0]), i) for i, b in sound if i != q and len(b) == len(a))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return sorted(out, key=repr)


def run(spark, items):
    df = spark.createDataFrame([(i, x, 1) for i, x in items], VECTORS).repartition(3)
    return rows(neighbours.nearest(df, F.col("vec_id") % 50 == 0))


def test_against_plain_search(spark):
    rng = np.random.default_rng(1)
    items = [(i, rng.standard_normal(32).tolist()) for i in range(400)]
    same = rng.standard_normal(32).tolist()
    items += [(400 + i, same) for i in range(60)]
    items += [(1000, None), (1050, []), (1100, [0.0] * 32), (1150, [None] + [1.0] * 31), (1200, [float("nan")] * 32), (1250, [float("inf")] * 32),
              (1300, [1.0, 2.0]), (1301, [2.0, 4.0]), (1350, [3.0]), (None, same), (7, items[7][1])]
    assert run(spark, items) == plain(items)


def test_recall_on_the_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = plain([(r.vec_id, r.embedding) for r in df.collect()])
    got = rows(neighbours.nearest(df, F.col("vec_id") % 50 == 0))
    found = {(q, v) for q, _, v, _ in got}
    assert len(found & {(q, v) for q, _, v, _ in want}) / len(want) >= 0.99
    assert len(got) == len(want)


def test_several_query_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    items = [(i * 50, rng.standard_normal(20).tolist()) for i in range(40)]
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 1000)
    assert run(spark, items) == plain(items)


def test_no_rows(spark):
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []


def test_few_pairs_are_compared_exactly(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 64)) * 10.0 ** rng.integers(-30, 30, (4000, 1))
    x[3000:3010] = x[50]
    ids, compared, plain_cosine = np.arange(len(x)), [], neighbours.exact_cosine
    monkeypatch.setattr(neighbours, "exact_cosine", lambda a, b: compared.append(len(a)) or plain_cosine(a, b))
    best = neighbours._Best(ids[::50], x[::50], 5)
    for lo in range(0, len(x), 1000):
        part = slice(lo, lo + 1000)
        batch = pa.RecordBatch.from_pydict({"vec_id": pa.array(ids[part]), "vector": pa.array(x[part].tolist(), pa.list_(pa.float64()))})
        found = next(neighbours._codes([batch]))
        best.add(ids[part], np.frombuffer(b"".join(found.column("code").to_pylist()), np.uint8).reshape(1000, -1), found.column("fit").to_numpy(), x[part])
    for place, q in enumerate(ids[::50]):
        score = plain_cosine(np.repeat(x[q][None], len(x), axis=0), x)
        score[q] = -2
        near = np.lexsort((ids, -score))[:5]
        assert best.vec[place].tolist() == near.tolist() and best.score[place].tolist() == score[near].tolist()
    assert sum(compared) < 0.05 * len(best.ids) * len(x), sum(compared)
