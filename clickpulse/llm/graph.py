"""Connected components by alternating stars, as joins and aggregates.

Every round replaces the edges by edges to smaller neighbours until each
component is one star around its smallest vertex. The minimum of a vertex'
neighbours is an aggregate and is joined back, so a vertex with very many
neighbours is spread over the tasks (partial aggregation, split skewed joins).
Each round is a table in the shared checkpoint folder: nothing is collected, and a
lost executor costs at most the round at hand.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.session import scratch_path

MAX_ROUNDS = 100


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of edges as stars around the smallest vertex of each of its parts."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int, parent: dict[int, int] = parent) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent.get(x, x)
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
            parent.setdefault(min(x, y), min(x, y))
        pairs = [(v, root(v)) for v in parent]
        pairs = [(v, r) for v, r in pairs if v != r]
        yield pa.RecordBatch.from_pydict({"u": pa.array([v for v, _ in pairs], pa.int64()), "v": pa.array([r for _, r in pairs], pa.int64())})


def _saved(df: DataFrame, folder: str, name: str) -> tuple[DataFrame, tuple]:
    """The written table and a summary that tells whether two rounds are equal."""
    spark = df.sparkSession
    df.write.parquet(f"{folder}/{name}")
    out = spark.read.parquet(f"{folder}/{name}")
    total = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return out, tuple(total)


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: two long columns, no nulls. Returns (``vertex``, ``root``): each vertex that
    isn't the smallest of its component, with the smallest."""
    folder = scratch_path(edges.sparkSession, f"components-{uuid.uuid4().hex}")
    a, b = edges.columns
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").mapInArrow(_forest, "u long, v long")
    e, before = _saved(e.distinct(), folder, "0")
    for n in range(1, MAX_ROUNDS + 1):
        if not before[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e, after = _saved(small.where("u <> v").distinct(), folder, str(n))
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    return e.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
