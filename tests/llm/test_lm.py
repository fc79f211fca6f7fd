import math
import zlib
from collections import Counter

import numpy as np

from clickpulse.llm import gru, lm_score
from tests.conftest import SF_ORACLE
from tests.llm.helpers import docs, lower, rows, with_clashes, words


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def plain(items):
    """(id, held_out, n_tokens, n_known, train_tokens, base score) of (id, text) pairs."""
    tokens = [(i, [*words(lower(t)), None]) for i, t in items]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted(((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens), key=repr)


def test_counts_and_base_score(spark):
    texts = [None, "", " \n", "A a b", "B c é É", "x" * 5000, "the cat the dog " * 40] * 4 + ["only here", "only there"] * 3
    items = [*enumerate(texts), (2, "again"), (2, "again"), (None, "null id")]
    df = with_clashes(spark.createDataFrame([(i, t, "s") for i, t in items], "doc_id LONG, text STRING, source STRING"))
    for chunk in (300, 1 << 23):
        got = rows(lm_score.score_documents(df, chunk_bytes=chunk))
        want = plain(items)
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-12)
        assert all(math.isfinite(g[6]) and g[6] < 0 for g in got)


def test_no_training_rows(spark):
    ids = [i for i in range(100) if held(i)][:3]
    df = spark.createDataFrame([(i, "a b") for i in ids], "doc_id LONG, text STRING")
    assert [r[2:5] for r in rows(lm_score.score_documents(df))] == [(3, 0, 0)] * 3
    assert lm_score.score_documents(docs(spark, [])).collect() == []


def test_held_out_likelihood_beats_word_frequencies(spark):
    out = lm_score.score_documents(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first().asDict()
    assert out["sum(score)"] > out["sum(base_score)"] + 0.2 * out["sum(n_tokens)"]


def test_scores_do_not_depend_on_the_layout(spark):
    table = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    found = []
    for parts in (1, 8, 32):
        out = rows(lm_score.score_documents(table.repartition(parts, "doc_id"), chunk_bytes=1 << 19), "doc_id", "score", "n_tokens")
        found.append(np.array([s / n for _, s, n in out]))
    assert np.abs(found[0] - found[1]).max() < 1e-3 and np.abs(found[0] - found[2]).max() < 1e-3


def test_equal_rows_that_would_fill_a_chunk_are_spread(spark):
    items = [(1, "the same words again and again")] * 300 + [(i, f"word{i} and the same") for i in range(2, 40)]
    df = spark.createDataFrame(items, "doc_id LONG, text STRING")
    got = rows(lm_score.score_documents(df, chunk_bytes=2000))
    assert [g[:5] for g in got] == [w[:5] for w in plain(items)]
    assert len({g[6] for g in got if g[0] == 1}) == 1


def _net():
    shape = gru.Shape((0, 1, 4, 9), 3, 5)
    return shape, np.random.default_rng(0).standard_normal(shape.total) * 0.3


def test_whole_document_likelihood_is_a_distribution_carried_on():
    shape, flat = _net()
    net, rng = gru.Gru(shape, flat), np.random.default_rng(1)
    texts = [rng.integers(0, 12, k) for k in (5, 70, 7, 1, 130)]
    for t in texts:
        t[-1] = 0
    for most in (1, 2, 8):
        got = net.log_likelihood(texts, most)
        for t, score in zip(texts, got, strict=True):
            h, before, want = np.zeros((1, 5), np.float32), t[-1], 0.0
            for w in t:
                h = net.window(np.array([[before]]), np.ones((1, 1), np.float32), h)[-1]
                every = np.array([net.output(h, np.array([x]))[0][0] for x in range(12)])
                assert abs(np.exp(every).sum() - 1) < 1e-4
                want, before = want + every[w], w
            assert abs(want - score) < 1e-3


def test_gradients(monkeypatch):
    shape, flat = _net()
    seen = {k: np.zeros(s) for k, s in shape.sizes.items()}

    def note(self, name, at, grad, rate):
        seen[name][at] += grad
    monkeypatch.setattr(gru.Gru, "_descend", note)
    text = np.random.default_rng(2).integers(0, 12, 9)
    text[-1] = 0
    gru.Gru(shape, flat).train(text, np.array([0, 9]), 1)
    got = np.concatenate([seen[k].ravel() for k in shape.sizes])
    loss = lambda f: -gru.Gru(shape, f).log_likelihood([text], 1)[0] * 32 / 9
    for i in np.random.default_rng(3).choice(shape.total, 40, replace=False):
        step = np.zeros(shape.total)
        step[i] = 1e-2
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-2 - got[i]) < 1e-2


def test_classes_have_about_equal_mass():
    counts = np.array([50, 20, 10, 5, 5, 4, 3, 2, 1])
    borders = gru.classes_by_mass(counts, 3)
    assert borders[0] == 0 and borders[-1] == 9 and list(borders) == sorted(set(borders))


def test_distinct_keys_are_those_of_a_full_sort():
    every = np.random.default_rng(12).integers(0, 1 << 64, 500, dtype=np.uint64)[np.random.default_rng(13).integers(0, 500, 20_000)]
    for some in (every, every[:1], np.full(9, lm_score.END)):
        want = np.unique(some, return_inverse=True)
        assert all(np.array_equal(a, b) for a, b in zip(lm_score._distinct(some), want, strict=True))
