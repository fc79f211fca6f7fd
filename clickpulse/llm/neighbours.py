"""Operator 5: nearest neighbours by cosine, from randomly rotated one-bit codes.

Unit vectors are rotated by one random orthogonal matrix and kept as the signs
of their components, with one scalar: how well the signs stand for the vector.
The inner product of a query with the signs, divided by that scalar, estimates
the cosine; the error is bounded in probability by ``SPREAD`` standard
deviations. A vector goes on only if its upper bound reaches the
query's fifth-best exact score so far; single-precision products of the unit vectors, ``ROUNDING``
more than their error can be, then leave the few that are compared exactly.

Every row is indexed and every query is compared with every code, in blocks of
queries of bounded size; a task keeps its own best for each query, and a
partial top-k merges them.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite
component, and rows without an id, take no part; vectors of different lengths
are never compared; rows that have the query's own id are not candidates; query
rows with one id are answered once; repeated candidate rows are candidates
each; equal scores go to the smaller id; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.plans import write_and_reread

K, SPREAD = 5, 3.5
#: Below this many dimensions the codes say too little: every vector is compared exactly.
MIN_DIMS = 16
BLOCK_BYTES = 8 << 20
#: Query by candidate estimates at a time, and exact comparisons at a time.
CELLS, PAIRS = 1 << 21, 1 << 14
#: What a single-precision product of unit vectors can be off, by component (2 ** -24 each for two inputs, a product and a sum), with room.
ROUNDING = 2.0 ** -21

_INDEX = "vec_id long, dims int, code binary, fit float, vector array<double>"
_FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _by_length(lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) for each length among the lists."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    for dims in np.unique(sizes):
        at = np.flatnonzero(sizes == dims)
        yield int(dims), at, lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)
    x = x / big  # else squares of large or small components leave the range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dims, at, x in _by_length(batch.column("vector")):
            turned = _unit(x).astype(np.float32) @ rotation(dims)
            bits = np.packbits(turned > 0, axis=1)
            fit = np.abs(turned).sum(axis=1) / np.sqrt(dims)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(at)), "dims": pa.array(np.full(len(at), dims, np.int32)),
                "code": pa.array([row.tobytes() for row in bits], pa.binary()), "fit": pa.array(fit.astype(np.float32)),
                "vector": batch.column("vector").take(pa.array(at))})


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Codes of all usable rows, as a written table."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return write_and_reread(rows.where(usable(F.col("vector")) & F.col("vec_id").isNotNull()).mapInArrow(_codes, _INDEX), "vector-codes")


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of paired rows in double precision, summed in order of the components."""
    total = lambda x, y: np.add.accumulate(x * y, axis=1)[:, -1]
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.sqrt(total(a, a) * total(b, b))
        out = total(a, b) / size
    odd = ~np.isfinite(out) | (size < 1e-150)
    if odd.any():
        out[odd] = (_unit(a[odd]) * _unit(b[odd])).sum(axis=1)
    return np.clip(out, -1, 1)


class _Best:
    """The k best exact scores of each query of one length, as rows come by."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.unit = _unit(queries).astype(np.float32)
        self.turned = self.unit @ rotation(queries.shape[1])
        self.score = np.full((len(ids), k), -np.inf)
        self.vec = np.full((len(ids), k), np.iinfo(np.int64).max)

    def _take(self, q: np.ndarray, r: np.ndarray, rows: np.ndarray, vectors: np.ndarray) -> None:
        """Compare pairs (query, row) exactly and keep the best."""
        own = self.ids[q] != rows[r]
        q, r = q[own], r[own]
        score = np.concatenate([exact_cosine(self.queries[q[i:i + PAIRS]], vectors[r[i:i + PAIRS]]) for i in range(0, len(q), PAIRS)]) if len(q) else np.zeros(0)
        touched = np.unique(q)
        if not len(touched):
            return
        every_q = np.concatenate([np.repeat(touched, self.k), q])
        every_s = np.concatenate([self.score[touched].ravel(), score])
        every_v = np.concatenate([self.vec[touched].ravel(), rows[r]])
        order = np.lexsort((every_v, -every_s, every_q))
        every_q = every_q[order]
        place = np.arange(len(order)) - np.searchsorted(every_q, every_q)
        top = place < self.k
        self.score[every_q[top], place[top]] = every_s[order][top]
        self.vec[every_q[top], place[top]] = every_v[order][top]

    def add(self, rows: np.ndarray, codes: np.ndarray, fit: np.ndarray, vectors: np.ndarray) -> None:
        dims = vectors.shape[1]
        step = max(1, CELLS // max(1, len(self.ids)))
        slack = SPREAD * np.sqrt(np.maximum(0, 1 - fit * fit)) / fit / np.sqrt(max(1, dims - 1)) + 1e-5
        if dims < MIN_DIMS:
            slack = np.full(len(fit), 3.0, dtype=np.float32)
        for lo in range(0, len(rows), step):
            part = slice(lo, lo + step)
            signs = np.unpackbits(codes[part], axis=1, count=dims).astype(np.float32) * 2 - 1
            about = (self.turned @ signs.T) / (np.sqrt(dims) * fit[part])
            # One more than asked for: the query's own row may be among them.
            first = np.argpartition(-about, min(self.k + 1, about.shape[1]) - 1, axis=1)[:, :self.k + 1]
            q = np.repeat(np.arange(len(self.ids)), first.shape[1])
            self._take(q, first.ravel(), rows[part], vectors[part])
            open_ = about + slack[part] >= self.score[:, -1:]
            open_[q, first.ravel()] = False  # compared already
            some = np.flatnonzero(open_.any(axis=0))
            if len(some):
                near = self.unit @ _unit(vectors[part][some]).astype(np.float32).T
                near += np.float32(ROUNDING * (dims + 8))
                q, r = np.nonzero(open_[:, some] & (near >= self.score[:, -1:]))
                self._take(q, some[r], rows[part], vectors[part])

    def rows(self) -> pa.RecordBatch:
        q, place = np.nonzero(self.score > -np.inf)
        return pa.RecordBatch.from_pydict({"query_id": pa.array(self.ids[q]), "vec_id": pa.array(self.vec[q, place]), "score": pa.array(self.score[q, place])})


def _search(block: pa.Table, k: int):
    ids = block.column("vec_id").combine_chunks().to_numpy(zero_copy_only=False)
    queries = {dims: (ids[at], x) for dims, at, x in _by_length(block.column("vector").combine_chunks())}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dims: _Best(i, x, k) for dims, (i, x) in queries.items()}
        for batch in batches:
            code = batch.column("code")
            for dims, at, x in _by_length(batch.column("vector")):
                if dims in best:
                    packed = np.frombuffer(b"".join(code.take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1)
                    best[dims].add(batch.column("vec_id").to_numpy(zero_copy_only=False)[at], packed, batch.column("fit").to_numpy(zero_copy_only=False)[at], x)
        for b in best.values():
            yield b.rows()
    return search


def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` nearest rows of each row that ``is_query``
    (an expression over ``vec_id``) picks."""
    index = build_index(vectors, id_col, vector_col)
    queries = write_and_reread(index.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")), "vector-queries")
    count, size = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vector")), F.lit(0)) * 8).first()
    blocks = max(1, -(-int(size) // BLOCK_BYTES))
    found = index.sparkSession.createDataFrame([], _FOUND)
    for b in range(blocks if count else 0):
        block = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()  # about BLOCK_BYTES, by the blocks' number
        if len(block):
            found = found.unionByName(index.mapInArrow(_search(block, k), _FOUND))
    rank = F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)")
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
