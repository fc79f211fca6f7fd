import itertools
import random

from pyspark.sql import functions as F

from clickpulse.llm import packing
from tests.llm.helpers import docs, rows, with_clashes, words


def padding(histogram, tops):
    return sum(min(b for b in tops if b >= top) * c - s for top, c, s in histogram)


def test_boundaries_have_the_least_padding():
    rng = random.Random(1)
    for _ in range(300):
        lengths = sorted(rng.sample(range(60), rng.randint(1, 9)))
        histogram = [(n, c, n * c) for n in lengths for c in [rng.randint(1, 9)]]
        k = rng.randint(1, 5)
        got = packing.boundaries(histogram, k)
        best = min(padding(histogram, [*some, lengths[-1]]) for r in range(k) for some in itertools.combinations(lengths[:-1], r))
        assert len(got) <= k and got[-1] == lengths[-1] and padding(histogram, got) == best
    assert packing.boundaries([], 4) == []


def test_batches_fill_the_budget(spark):
    rng = random.Random(2)
    texts = [None, "", *[" ".join("w" for _ in range(rng.choice([1, 2, 3, 10, 11, 50, 51, 52, 300]))) for _ in range(400)], "w " * 9000]
    df = with_clashes(docs(spark, texts, extra=[(5, texts[5], None, None, None), (None, "w w", None, None, None)]))
    out = packing.pack(df, buckets=5, budget=600).collect()
    assert len(out) == len(texts) + 2
    size = {i: len(words(t)) for i, t in enumerate(texts)} | {None: 2}
    boxes = {}
    for r in out:
        assert r.n_tokens == size[r.doc_id] and r.padding == r.pad_to - r.n_tokens >= 0
        boxes.setdefault((r.bucket, r.pad_to), {}).setdefault(r.batch, []).append(r)
    assert len(boxes) <= 5 and len({b for b, _ in boxes}) == len(boxes)
    for (_, pad), batches in boxes.items():
        room = max(1, 600 // max(1, pad))
        full = sorted(map(len, batches.values()))
        assert sorted(batches) == list(range(len(batches))) and full[-1] <= room and all(n == room for n in full[1:])
    histogram = {}
    for r in out:
        top, c, s = histogram.get(r.n_tokens, (r.n_tokens, 0, 0))
        histogram[r.n_tokens] = (top, c + 1, s + r.n_tokens)
    best = packing.boundaries([histogram[n] for n in sorted(histogram)], 5)
    assert sum(r.padding for r in out) <= padding(histogram.values(), best) + 300  # 9,000 tokens share a step of two


def test_few_lengths_and_no_rows(spark):
    assert {(r.n_tokens, r.pad_to, r.bucket) for r in packing.pack(docs(spark, ["a", "a b", "a b"])).collect()} == {(1, 1, 0), (2, 2, 1)}
    assert packing.pack(docs(spark, [])).collect() == []
    assert rows(packing.pack(docs(spark, [None, ""])), "n_tokens", "pad_to", "batch") == [(0, 0, 0), (0, 0, 0)]


def test_long_lengths_are_told_apart(spark, monkeypatch):
    df = docs(spark, ["w " * n for n in [4096, 4096, 4096, 4097, 9001, 9002, 9003]])
    assert {(r.n_tokens, r.pad_to) for r in packing.pack(df, buckets=5).collect()} == {(n, n) for n in (4096, 4097, 9001, 9002, 9003)}
    monkeypatch.setattr(packing, "MOST_LENGTHS", 4)
    out = packing.pack(df, buckets=5).collect()
    assert len(out) == 7 and 0 < sum(r.padding for r in out) <= sum(r.pad_to for r in out) / 2048


def test_every_length_counts_however_many_there_are(spark):
    n = (1 << 16) + 3000
    histogram = packing._histogram(spark.range(n).select(F.col("id").alias("n_tokens")))
    assert histogram == [(i, 1, i) for i in range(n)]
    tops = packing.boundaries(histogram, 2)
    assert tops[-1] == n - 1 and tops[0] in (n // 2 - 1, n // 2)
