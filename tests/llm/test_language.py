import math
import random
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from clickpulse.llm import language
from tests.conftest import SF_ORACLE
from tests.llm.helpers import DOCS, docs, rows, with_clashes


def test_held_out_accuracy_and_calibration(spark):
    df = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    out = language.identify(df).join(df.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(out) == df.count()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    held = out[out.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert held.score.between(0, 1).all() and abs(held.score.mean() - (held.lang == held.lang_pred).mean()) < 0.05


def _two_languages(n, seed=0):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        letters, lang = ("abcde", "x") if i % 2 else ("vwxyz", "y")
        made.append((i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(12)), lang, "s", 0))
    return made


def test_awkward_rows(spark):
    extra = [(1000, None, "x", None, None), (1001, "", "x", None, None), (1002, "123 ... !!", "x", None, None),
             (1003, "abcde edcba", None, None, None), (1003, "abcde edcba", None, None, None), (None, "vwxyz", None, None, None),
             (1004, "abcde " * 30_000, None, None, None)]
    df = spark.createDataFrame(_two_languages(120) + extra, DOCS)
    got = rows(language.identify(with_clashes(df)).where("doc_id >= 1000 OR doc_id IS NULL"), "doc_id", "lang_pred")
    assert got == sorted([(1000, "und"), (1001, "und"), (1002, "und"), (1003, "x"), (1003, "x"), (1004, "x"), (None, "y")], key=repr)
    kept = language.accepted(with_clashes(df))
    assert kept.columns == with_clashes(df).columns and kept.where("doc_id IN (1000, 1001, 1002)").count() == 0
    assert kept.where("doc_id < 1000").count() == 120


def test_nothing_to_learn_from_or_nothing_at_all(spark):
    out = language.identify(docs(spark, ["some text", None], lang=None))
    assert rows(out, "lang_pred", "score") == [("und", 0.0), ("und", 0.0)]
    assert language.identify(docs(spark, [])).collect() == []


def test_predictions_use_the_text_alone(spark):
    df = spark.createDataFrame(_two_languages(160), DOCS)
    a = language.identify(df)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    swapped = df.withColumn("lang", F.when(held, F.lit("y")).otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    assert rows(a) == rows(language.identify(swapped))


def test_every_language_is_learned_and_too_many_are_an_error(spark, monkeypatch):
    import pytest
    rng = random.Random(4)
    alphabet = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    made = [(i, " ".join("".join(rng.choice(alphabet[3 * k:3 * k + 3]) for _ in range(4)) for _ in range(8)), f"l{k:03}", "s", 0) for i, k in enumerate(list(range(300)) * 5)]
    df = spark.createDataFrame(made, DOCS)
    model = language.fit(df)
    assert model.langs == [f"l{k:03}" for k in range(300)] and model.weights.shape[1] == 300
    monkeypatch.setattr(language, "MAX_LANGS", 299)
    with pytest.raises(ValueError, match="299"):
        language.fit(df)


def test_repeated_and_null_ids_in_any_order_give_the_same_scores(spark):
    made = [(i // 3 if i % 2 else None, t, lang, s, n) for i, t, lang, s, n in _two_languages(150)]
    a = language.identify(spark.createDataFrame(made, DOCS).repartition(1))
    b = language.identify(spark.createDataFrame(made[::-1], DOCS).repartition(7))
    assert rows(a) == rows(b)
    only_null = spark.createDataFrame([(None, *r[1:]) for r in made], DOCS)
    out = [(r[1], r[2]) for r in rows(language.identify(only_null), "doc_id", "lang_pred", "score")]
    assert {x for x, _ in out} == {"x", "y"} and min(p for _, p in out) > 0.6


def test_without_labels_texts_with_a_letter_are_accepted(spark):
    df = docs(spark, ["some text", None, "123", "é"], lang=None)
    assert sorted(r.doc_id for r in language.accepted(df).collect()) == [0, 3]


def plain_ftrl(rows, labels, k):
    """FTRL with elastic net, a coordinate at a time, in the same order of mini-batches."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i, c):
        v = z[i, c]
        if abs(v) <= language.L1:
            return 0.0
        return -(v - math.copysign(language.L1, v)) / ((language.BETA + math.sqrt(n[i, c])) / language.ALPHA + language.L2)

    rng = np.random.default_rng(0)
    for _ in range(language.EPOCHS):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), language.BATCH):
            grad, used = defaultdict(float), {}
            for i in order[lo:lo + language.BATCH]:
                x = {**rows[i], -1: 1.0}
                used.update({(f, c): weight(f, c) for f in x for c in range(k)})
                logits = [sum(v * used[f, c] for f, v in x.items()) for c in range(k)]
                total = sum(math.exp(v) for v in logits)
                for c in range(k):
                    error = math.exp(logits[c]) / total - (labels[i] == c)
                    for f, v in x.items():
                        grad[f, c] += v * error / len(order[lo:lo + language.BATCH])
            for at, g in grad.items():
                z[at] += g - (math.sqrt(n[at] + g * g) - math.sqrt(n[at])) / language.ALPHA * used[at]
                n[at] += g * g
    return weight


def test_fit_equals_a_plain_version():
    rng = np.random.default_rng(7)
    rows, labels = [], rng.integers(0, 3, 40)
    for label in labels:
        features = np.sort(rng.choice(30, 6, replace=False)) * 100 + label
        rows.append((features, rng.random(6).astype(np.float32)))
    got, bias = language._fit_ftrl(rows, labels, 3)
    want = plain_ftrl([dict(zip(f.tolist(), v.tolist())) for f, v in rows], labels, 3)
    every = sorted({int(f) for r, _ in rows for f in r})
    assert np.allclose([[got[f, c] for c in range(3)] for f in every], [[want(f, c) for c in range(3)] for f in every], atol=1e-5)
    assert np.allclose(bias, [want(-1, c) for c in range(3)], atol=1e-5) and (got[np.setdiff1d(np.arange(language.FEATURES), every)] == 0).all()


def test_tfidf_equals_a_plain_version():
    row, feature, count = np.array([0, 0, 1]), np.array([3, 9, 3]), np.array([2, 1, 5])
    idf = np.linspace(1, 2, language.FEATURES)
    got = language.tfidf(row, feature, count, idf, 2)
    a, b = (1 + math.log(2)) * idf[3], idf[9]
    assert np.allclose(got, [a / math.hypot(a, b), b / math.hypot(a, b), 1], atol=1e-6)


def test_temperature_is_the_likeliest():
    rng = np.random.default_rng(1)
    logits, labels = rng.standard_normal((400, 3)) * 4, rng.integers(0, 3, 400)
    t = language._temperature(logits, labels)
    loss = lambda t: -np.log(language.softmax(logits / t)[np.arange(400), labels]).mean()
    assert loss(t) <= loss(t * 0.8) and (t == 5 or loss(t) <= loss(t * 1.2))
