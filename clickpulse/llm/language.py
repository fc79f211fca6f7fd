"""Operator 3: language by sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies cover all training rows. The weights are fitted with
follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties) on at
most ``FIT_PER_LANG`` different rows of each language, chosen by a hash of id, text and language (so
null or repeated ids are rows like any other, and equal rows are learned from once), and
their probabilities are calibrated with one temperature on a fifth of that
sample. Both are bounded by parameters, whatever the size of the corpus;
prediction runs over every whole text. Every language of the training rows is learned; more than ``MAX_LANGS``
of them, which the model's table on the driver can't hold, are an error.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if no row can be learned from (``accepted`` then keeps every text with a letter). Rows with a null language are predicted but not
learned from; repeated rows are all returned; of equally probable languages the first by name is taken; a very long text is
one slice of a batch; an empty table gives an empty result; only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from clickpulse.llm import textcols as T

LENGTHS = (1, 2, 3)
FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
FIT_PER_LANG = 500
MAX_LANGS = 512
SLICE = 1 << 19
EPOCHS, BATCH = 4, 16
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.001
UNKNOWN = "und"
#: The pipeline rejects documents below this score.
MIN_SCORE = 0.5

_SALTS = [np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25), np.uint64(0xC13FA9A902A6328F)]
SCHEMA = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def _lower_table() -> np.ndarray:
    """Lower case of the letters below U+3000 that have one of one code point; white space is one symbol."""
    table = np.arange(0x3000, dtype=np.uint32)
    for i in range(0x3000):
        low = chr(i).lower()
        if len(low) == 1:
            table[i] = ord(low)
        if chr(i).isspace():
            table[i] = 32
    return table


_LOWER = _lower_table()


def _points(part: T.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of the rows, and their offsets."""
    points = np.frombuffer(part.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), dtype="<u4").copy()
    small = points < len(_LOWER)
    points[small] = _LOWER[points[small]]
    heads = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
    return points, heads[part.offsets]


def grams(part: T.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, count) of the character n-grams of a slice, in order of row and feature."""
    points, offsets = _points(part)
    row = np.repeat(np.arange(part.rows, dtype=np.uint64), np.diff(offsets))
    keys, h = [], np.zeros(len(points), dtype=np.uint64)
    for n in LENGTHS:
        if len(points) < n:
            break
        h = h[:len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1:] + np.uint64(1)
        spread = (h ^ (h >> np.uint64(29))) * _SALTS[n - 1]
        key = (row[:len(h)] << np.uint64(FEATURE_BITS)) | (spread >> np.uint64(64 - FEATURE_BITS))
        keys.append(key[row[:len(h)] == row[n - 1:]] if n > 1 else key)
    every = np.sort(np.concatenate(keys)) if keys else np.zeros(0, dtype=np.uint64)
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    distinct = every[first]
    return (distinct >> np.uint64(FEATURE_BITS)).astype(np.int64), (distinct & np.uint64(FEATURES - 1)).astype(np.int64), np.diff(np.append(first, len(every)))


def tfidf(row: np.ndarray, feature: np.ndarray, count: np.ndarray, idf: np.ndarray, rows: int) -> np.ndarray:
    """Weights of unit length by row: (1 + ln count) * idf."""
    value = (1 + np.log(count)) * idf[feature]
    norm = np.sqrt(np.bincount(row, value * value, minlength=rows))
    return (value / np.where(norm > 0, norm, 1)[row]).astype(np.float32)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, rows = np.zeros(FEATURES, dtype=np.int64), 0
    for batch in batches:
        rows += batch.num_rows
        for part in T.slices(batch.column(0), SLICE):
            seen += np.bincount(grams(part)[1], minlength=FEATURES)
    T.trim()
    used = np.flatnonzero(seen)
    yield pa.RecordBatch.from_pydict({"feature": pa.array(np.append(used, -1)), "n": pa.array(np.append(seen[used], rows))})


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse counts of the sampled rows: the fit sees these, never the texts."""
    for batch in batches:
        parts = []
        for part in T.slices(batch.column("text"), SLICE):
            row, feature, count = grams(part)
            edges = np.searchsorted(row, np.arange(part.rows + 1)).astype(np.int32)
            parts.append(pa.RecordBatch.from_pydict({
                "lang": batch.column("lang").slice(part.lo, part.rows),
                "feature": pa.ListArray.from_arrays(edges, pa.array(feature.astype(np.int32))),
                "n": pa.ListArray.from_arrays(edges, pa.array(count.astype(np.int32)))}))
        yield from parts


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features by languages
    bias: np.ndarray
    temperature: float

    def probabilities(self, part: T.Slice) -> np.ndarray:
        row, feature, count = grams(part)
        x = tfidf(row, feature, count, self.idf, part.rows)
        logits = np.stack([np.bincount(row, x * self.weights[feature, k], minlength=part.rows) for k in range(len(self.langs))], axis=1)
        return softmax((logits + self.bias) / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias. ``rows``: (features, values) of each example."""
    z, n = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))

    def weights(at: np.ndarray) -> np.ndarray:
        own, rate = z[at], (BETA + np.sqrt(n[at])) / ALPHA
        return -np.sign(own) * np.maximum(np.abs(own) - L1, 0) / (rate + L2)

    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH]
            sizes = [len(rows[i][0]) + 1 for i in some]
            feature = np.concatenate([np.append(rows[i][0], FEATURES) for i in some])
            value = np.concatenate([np.append(rows[i][1], 1.0) for i in some])[:, None]
            at, back = np.unique(feature, return_inverse=True)
            w = weights(at)
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            error = softmax(np.add.reduceat(value * w[back], begins, axis=0))
            error[np.arange(len(some)), labels[some]] -= 1
            spread = value * np.repeat(error, sizes, axis=0) / len(some)
            g = np.stack([np.bincount(back, spread[:, c], minlength=len(at)) for c in range(k)], axis=1)
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(np.arange(FEATURES + 1))
    return w[:-1].astype(np.float32), w[-1]


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The one that gives the held rows the largest likelihood, if one more row than seen were wrong
    (a sample without an error says no more than that)."""
    if not len(labels):
        return 1.0
    wrong = 1 / (len(labels) + 2)

    def loss(t: float) -> float:
        p = np.clip(softmax(logits / t)[np.arange(len(labels)), labels], 1e-300, 1 - 1e-15)
        return -float(((1 - wrong) * np.log(p) + wrong * np.log1p(-p)).mean())

    return float(min(np.geomspace(0.02, 5, 120), key=loss))


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = FIT_PER_LANG) -> Model | None:
    """Learn from the rows of ``train`` with a language and a text; None if there are none."""
    T.small_batches(train.sparkSession)
    rows = train.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    rows = rows.select(F.xxhash64("id", "text", "lang").alias("key"), "text", "lang")
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGS + 1).collect())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not langs:
        return None
    seen = rows.select("text").mapInArrow(_document_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(seen.column(0).to_pylist(), seen.column(1).to_pylist(), strict=True))
    total, df = found.pop(-1), np.zeros(FEATURES)
    df[list(found)] = list(found.values())
    idf = np.log((1 + total) / (1 + df)) + 1
    # The first rows of each shard of a language, then of the language: no task gets a share from every other one.
    picked = rows.select("key", "lang").distinct().withColumn("shard", F.expr("pmod(xxhash64(key), 64)"))
    for group in ("lang, shard", "lang"):
        picked = picked.select("key", "lang", "shard", F.expr(f"row_number() OVER (PARTITION BY {group} ORDER BY key)").alias("n")).where(F.col("n") <= per_lang)
    keep = F.broadcast(picked.select("key")) if len(langs) * per_lang <= 200_000 else picked.select("key")
    sample = rows.join(keep, "key", "left_semi").dropDuplicates(["key"]).orderBy("key")
    got = sample.select("text", "lang").mapInArrow(_vectors, "lang string, feature array<int>, n array<int>").toArrow()
    place = {x: i for i, x in enumerate(langs)}
    labels = np.array([place[x] for x in got.column("lang").to_pylist()], dtype=np.int64)
    examples = []
    for f, c in zip(got.column("feature"), got.column("n"), strict=True):
        feature, count = f.values.to_numpy(), c.values.to_numpy()
        examples.append((feature, tfidf(np.zeros(len(feature), np.int64), feature, count, idf, 1)))
    held = np.arange(len(labels)) % 5 == 4
    fitted = [examples[i] for i in np.flatnonzero(~held)]
    weights, bias = _fit_ftrl(fitted, labels[~held], len(langs))
    logits = np.array([x @ weights[f] + bias for f, x in (examples[i] for i in np.flatnonzero(held))]).reshape(-1, len(langs))
    return Model(langs, idf, weights, bias, _temperature(logits, labels[held]))


def predictor(model: Model | None):
    """A column function from text to (``lang_pred``, ``score``)."""
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return lambda text: unknown

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = np.array(model.langs, dtype=object)
        for texts in batches:
            p = [model.probabilities(part) for part in T.slices(texts, SLICE)]
            best = np.concatenate([x.argmax(axis=1) for x in p]) if p else np.zeros(0, np.int64)
            score = np.concatenate([x.max(axis=1) for x in p]) if p else np.zeros(0)
            yield pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])
        T.trim()

    udf = F.arrow_udf(predict, SCHEMA)
    return lambda text: F.when(text.rlike(r"\p{L}"), udf(text)).otherwise(unknown)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row for each row of ``docs``: id, ``held_out``, ``lang_pred`` and ``score``; learns from the rows not held out."""
    held = held_out(F.col(id_col))
    predict = predictor(fit(docs.where(~held), id_col, text_col, lang_col))
    return docs.select(F.col(id_col), held.alias("held_out"), predict(F.col(text_col)).alias("p")).select(id_col, "held_out", "p.lang_pred", "p.score")


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is recognised with at least ``min_score``; without a row to learn from,
    those with a letter."""
    model = fit(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col)
    if model is None:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    p = predictor(model)(F.col(text_col))
    return docs.where((p["lang_pred"] != UNKNOWN) & (p["score"] >= min_score))
