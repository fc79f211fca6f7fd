"""Operator 8: padded batches from optimal length buckets.

The global histogram of lengths has an entry for each length, however many there are: n different
lengths take at least n * (n - 1) / 2 tokens, so their number grows at most like the root of
the corpus (one of 10 ** 11 tokens has fewer than 450,000). Dynamic programming over it finds
the bucket boundaries with the least padding: the cost of a bucket is linear in
its boundary, so the best earlier boundary comes from a lower envelope of lines in one sweep.
Only who sets ``MOST_LENGTHS`` gets a smaller table: above it lengths from ``EXACT`` share
steps of at most 1/2048 of their length (their true maximum and sum are kept),
which adds at most 1/2048 of the padded tokens to the least padding.
Batches then fill up inside each bucket: all documents are padded to the
bucket's length, and a batch holds as many as the token budget allows.

A document's place in its bucket is its rank in its shard plus the documents in
earlier shards of the bucket; the rank's window covers one of ``SHARDS`` shards of one
bucket, never a whole bucket.

Defined cases: a null or empty text has 0 tokens and is packed like any other;
a document longer than the budget is a batch of its own; with fewer distinct
lengths than buckets each length is a bucket; repeated rows each take a place;
an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.plans import write_and_reread

BUCKETS, TOKEN_BUDGET = 16, 65_536
EXACT, SHARDS = 4096, 1024
#: Distinct lengths that the driver's table holds one by one (None: all, whatever the input).
MOST_LENGTHS: int | None = None


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def boundaries(histogram: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """The largest lengths of at most ``buckets`` buckets with the least total padding.

    ``histogram``: (largest length, documents, tokens) of each step, ascending.
    """
    m = len(histogram)
    top = [0, *(b for b, _, _ in histogram)]
    docs, tokens = [0], [0]
    for _, c, s in histogram:
        docs.append(docs[-1] + c)
        tokens.append(tokens[-1] + s)
    best: list[int | None] = [0] + [None] * m
    came: list[array] = []
    for _ in range(min(buckets, m)):
        # best[j] = min over i < j of best[i] + top[j] * (docs[j] - docs[i]) - (tokens[j] - tokens[i])
        lines: deque[tuple[int, int, int]] = deque()  # slope, intercept, i
        now: list[int | None] = [None] * (m + 1)
        back = array("q", bytes(8 * (m + 1)))
        for j in range(1, m + 1):
            if best[j - 1] is not None:
                slope, at = -docs[j - 1], best[j - 1] + tokens[j - 1]
                while len(lines) > 1 and (at - lines[-2][1]) * (lines[-2][0] - lines[-1][0]) <= (lines[-1][1] - lines[-2][1]) * (lines[-2][0] - slope):
                    lines.pop()
                lines.append((slope, at, j - 1))
            if not lines:
                continue
            x = top[j]
            while len(lines) > 1 and lines[1][0] * x + lines[1][1] <= lines[0][0] * x + lines[0][1]:
                lines.popleft()
            now[j] = lines[0][0] * x + lines[0][1] + x * docs[j] - tokens[j]
            back[j] = lines[0][2]
        best = now
        came.append(back)
    found, j = [], m
    for back in reversed(came):
        if j:
            found.append(top[j])
            j = back[j]
    return found[::-1]


def _histogram(sized: DataFrame) -> list[tuple[int, int, int]]:
    """(largest length, documents, tokens), ascending: of each length, or of each step if a set ``MOST_LENGTHS`` is less than their number."""
    by_length = sized.groupBy("n_tokens").count()
    lengths = (by_length if MOST_LENGTHS is None else by_length.limit(MOST_LENGTHS + 1)).toArrow()
    if MOST_LENGTHS is None or len(lengths) <= MOST_LENGTHS:
        return sorted((n, c, n * c) for n, c in zip(lengths.column("n_tokens").to_pylist(), lengths.column("count").to_pylist(), strict=True))
    step = F.expr(f"IF(n_tokens < {EXACT}, 0, CAST(floor(log2(n_tokens / {EXACT})) AS INT) + 1)")
    binned = sized.select("n_tokens", step.alias("s")).select("n_tokens", F.expr("shiftleft(shiftright(n_tokens, s), s)").alias("low"))
    histogram = binned.groupBy("low").agg(F.max("n_tokens").alias("top"), F.count(F.lit(1)).alias("c"), F.sum("n_tokens").alias("s")).orderBy("low").collect()
    return [(r["top"], r["c"], r["s"]) for r in histogram]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """One row for each row of ``docs``: id, ``n_tokens``, ``bucket`` (from 0), ``pad_to``, ``padding`` and
    ``batch`` (from 0 in each bucket)."""
    sized = write_and_reread(docs.select(F.col(id_col).alias("id"), word_count(F.col(text_col)).alias("n_tokens"), F.monotonically_increasing_id().alias("key")), "packing-lengths")
    tops = boundaries(_histogram(sized), buckets)
    if not tops:
        return sized.select(F.col("id").alias(id_col), "n_tokens", *(F.lit(0).cast("long").alias(c) for c in ("bucket", "pad_to", "padding", "batch")))
    limits = F.array(*(F.lit(b).cast("long") for b in tops))
    placed = sized.withColumn("bucket", F.size(F.filter(limits, lambda b: b < F.col("n_tokens"))).cast("long")).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(SHARDS)))
    before = placed.groupBy("bucket", "shard").count().select("bucket", "shard", F.expr("coalesce(sum(count) OVER (PARTITION BY bucket ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("earlier"))
    ranked = placed.withColumn("own", F.expr("row_number() OVER (PARTITION BY bucket, shard ORDER BY key) - 1"))
    pad = F.element_at(limits, (F.col("bucket") + 1).cast("int"))
    room = F.greatest(F.floor(F.lit(budget) / F.greatest(pad, F.lit(1))), F.lit(1))
    return (ranked.join(F.broadcast(before), ["bucket", "shard"])  # at most BUCKETS * SHARDS rows
            .select(F.col("id").alias(id_col), "n_tokens", "bucket", pad.alias("pad_to"), (pad - F.col("n_tokens")).alias("padding"),
                    F.floor((F.col("earlier") + F.col("own")) / room).cast("long").alias("batch")))
