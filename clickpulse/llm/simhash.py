"""Operator 9: SimHash near-duplicates by deletion-variant signatures.

Fingerprints within two bits: cut into two halves, one half differs by at most
one bit. Each distinct fingerprint is indexed under its 64 one-wildcard
variants (a half with one bit blanked), an equality join brings candidates
together, and the whole fingerprints are compared. Equal fingerprints are one
class before that, so copies never meet in the join.

A half that very many fingerprints share would make a variant's bucket large.
Such buckets are left out of the join; their members are indexed under
two-wildcard variants instead, whose buckets hold four fingerprints at most,
all within two bits of each other. Both ways find every link.

Defined cases: a null, empty or white text has fingerprint zero and is linked
like any other; a null id is never a component's id unless it has no other;
repeated rows are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from clickpulse.llm import textcols as T
from clickpulse.llm.graph import connected_components
from clickpulse.plans import write_and_reread

SHINGLE_WORDS, SEED, MAX_BITS = 3, 42, 2
#: A half that so many distinct fingerprints share is indexed with two wildcards.
HEAVY_HALF = 256

_HALF = "(fp >> (32 * CAST({h} AS INT))) & 4294967295L"
#: Wildcard j blanks bit j % 32 of half j div 32; the rest of the half is the key's low word.
_VARIANTS = f"transform(sequence(0L, 63L), j -> (j << 32) | ({_HALF.format(h='(j div 32)')} & ~(1L << CAST(j % 32 AS INT))))"


def fingerprints(part: T.Slice) -> np.ndarray:
    """64-bit SimHash of each row of one slice."""
    w = T.words(part)
    n_words = np.diff(w.row_offsets)
    # The words again, one space after each: a shingle is then one stretch of bytes.
    index, offsets = T.ragged(w.starts, w.ends - w.starts + 1)
    joined = T.LOWER[part.data[np.minimum(index, max(len(part.data) - 1, 0))]]
    joined[offsets[1:] - 1] = 32
    text, begins, ends = joined.tobytes(), offsets[:-1], offsets[1:] - 1
    width = np.minimum(SHINGLE_WORDS, n_words)
    count = np.where(n_words > 0, n_words - width + 1, 0)
    first, rows = T.ragged(w.row_offsets[:-1], count)
    last = first + np.repeat(width, count) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(begins[first].tolist(), ends[last].tolist(), strict=True)), dtype=np.uint64, count=len(first))
    out = np.zeros(part.rows, dtype=np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for lo in range(0, part.rows, 256):
        hi = min(lo + 256, part.rows)
        own = hashes[rows[lo]:rows[hi]]
        bits = np.unpackbits(own.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        full = np.flatnonzero(count[lo:hi])
        if len(full):
            sums = np.add.reduceat(bits, rows[lo + full] - rows[lo], axis=0, dtype=np.int64)
            out[lo + full] = ((2 * sums > count[lo + full, None]) * weights).sum(axis=1, dtype=np.uint64)
    return out


def _fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        parts = [fingerprints(p) for p in T.slices(texts)]
        yield pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))
    T.trim()


fingerprint_of = F.arrow_udf(_fingerprints, LongType())


def _pairs(keyed: DataFrame) -> DataFrame:
    """Fingerprints under one key, at most ``MAX_BITS`` apart."""
    near = (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= MAX_BITS)
    keys = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in keyed.columns if c != "fp"]
    on = keys[0]
    for k in keys[1:]:
        on &= k
    return keyed.alias("a").join(keyed.alias("b").hint("merge"), on & near).select(F.col("a.fp").alias("fp"), F.col("b.fp").alias("fp2")).distinct()


def links(distinct_fps: DataFrame, heavy_half: int = HEAVY_HALF) -> DataFrame:
    """All pairs (``fp`` < ``fp2``) of the distinct long column ``fp`` that differ in one or two bits."""
    variants = distinct_fps.select("fp", F.explode(F.expr(_VARIANTS)).alias("key"))
    halves = distinct_fps.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("h")).select("h", F.expr(_HALF.format(h="h")).alias("half"))
    heavy = write_and_reread(halves.groupBy("h", "half").count().where(F.col("count") > heavy_half), "simhash-heavy")
    if heavy.isEmpty():
        return _pairs(variants)
    hot = heavy.select(F.explode(F.expr("transform(sequence(0L, 31L), p -> ((CAST(h AS BIGINT) * 32 + p) << 32) | (half & ~(1L << CAST(p AS INT))))")).alias("key")).distinct()
    members = variants.join(hot, "key", "left_semi").select("fp", "key", (F.expr("key >> 37")).alias("h"))
    other = _HALF.format(h="(1 - h)")
    # one wildcard in either half, or two in the other half beside an exact one
    across = members.select("fp", "key", F.explode(F.expr(f"transform(sequence(0L, 31L), q -> (q << 32) | (({other}) & ~(1L << CAST(q AS INT))))")).alias("key2"))
    exact = members.select("fp", "h").distinct().select("fp", F.expr(f"-1 - ((h << 32) | ({_HALF.format(h='h')}))").alias("key"), F.explode(F.expr(
        f"flatten(transform(sequence(0L, 30L), q -> transform(sequence(q + 1, 31L), r -> (q << 37) | (r << 32) | (({other}) & ~(1L << CAST(q AS INT)) & ~(1L << CAST(r AS INT))))))")).alias("key2"))
    return _pairs(variants.join(hot, "key", "left_anti")).unionByName(_pairs(across)).unionByName(_pairs(exact)).distinct()


def components(fps: DataFrame) -> DataFrame:
    """``fps``: a long column ``fp`` and any id column ``id``, a written table. Returns ``fp`` and ``component``, the smallest id
    that links of at most two bits reach, once for each distinct fingerprint."""
    classes = write_and_reread(fps.groupBy("fp").agg(F.min("id").alias("first")), "simhash-classes")
    roots = connected_components(links(classes.select("fp")))
    rooted = classes.join(roots, classes.fp == roots.vertex, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return rooted.join(least, "root").select("fp", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, ``fingerprint`` (hex) and ``component_id``."""
    T.small_batches(docs.sparkSession)
    fps = write_and_reread(docs.select(F.col(id_col).alias("id"), fingerprint_of(F.col(text_col)).alias("fp")), "simhash-fps")
    return fps.join(components(fps), "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, but only the first of each component: by id, then by a hash of its text (of equal rows, any one)."""
    T.small_batches(docs.sparkSession)
    key = "_row_key"
    tagged = write_and_reread(docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), fingerprint_of(F.col(text_col)).alias("fp"), F.xxhash64(text_col).alias("said"), F.monotonically_increasing_id().alias(key)), "simhash-docs")
    thin = tagged.select("id", "fp", "said", key)
    best = F.row_number().over(Window.partitionBy("component").orderBy(F.col("id").asc_nulls_last(), "said", key))
    first = thin.join(components(thin), "fp").select(key, best.alias("n")).where("n = 1").select(key)
    return tagged.join(first, key, "left_semi").select("row.*")
