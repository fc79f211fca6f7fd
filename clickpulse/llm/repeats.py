"""Operator 2: remove byte strings that an earlier document has, by depth-limited radix sort of suffixes.

Two windows of ``WINDOW`` bytes are equal exactly if their suffixes agree to
that depth, so suffixes are ordered by the most significant digits first and
only to that depth; equal groups are the repeated windows, and the smallest id of a
group is the only document that keeps its window.

Sorting every suffix of the corpus in one place would move many times the
input. Equal windows contain the same smallest k-gram (by hash), so:

1. Each chunk of documents sends the hashes of its windows' smallest k-grams
   (about one for each 13 bytes, a few bytes each, sorted and told apart by
   their differences). A range of hashes meets in one group, which answers with a bit
   for each: does another document hold it.
2. For those alone, each chunk sends the distinct stretches of text around
   them. Again a range of hashes meets, as the sort's first, coarse digit; its
   suffixes are ordered by the next digits of eight bytes, groups of one
   leave at once, and the answer is a bit for each window: an earlier document has it.
3. Each chunk marks the windows and cuts the covered bytes.

Documents are shuffled once (the three steps share the exchange); what moves
besides is bounded by distinct strings of a chunk, so copies and common passages
are merged before they meet. Hash collisions cost time only: stretches and suffixes are compared by their bytes.

Defined cases: a null text is empty; a text below ``WINDOW`` bytes is left
whole; a null id counts as larger than any other, or (``nulls_last=False``, as the
query has it) is smaller or larger than none, its text left whole; rows with equal ids don't
affect each other; an empty table gives an empty result; other columns are
carried in a struct, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from clickpulse.llm import textcols as T
from clickpulse.plans import write_and_reread

WINDOW = 50
#: Length of the k-grams; a window holds WINDOW - GRAM + 1 of them.
GRAM = 26
CHUNK_BYTES = 4 << 20
#: Grams hashed at a time.
STEP = 1 << 18
HASH_BITS = 48
#: Stretches handled at a time.
PART = 1 << 14
#: What a row takes besides its text.
ROW_BYTES = 64
NO_ID = np.iinfo(np.int64).max

_SYMBOL = T.mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_ANSWER = "chunk long, step int, bucket long, bits binary"


@dataclass
class Runs:
    """Neighbouring windows with the same smallest gram: first and last window start, the gram's hash, and the row."""

    first: np.ndarray
    last: np.ndarray
    hash: np.ndarray
    row: np.ndarray


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def runs(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Runs:
    """All windows inside the rows, by their smallest gram (the leftmost, on ties)."""
    found = []
    place = np.uint64((1 << 24) - 1)
    for lo in range(0, max(0, len(data) - window + 1), STEP):
        hi = min(len(data), lo + STEP + window - 1)
        h = T.Rolling(_SYMBOL[data[lo:hi]]).windows(gram)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9FB21C651E98DF25)
        at = _least((h & ~place) | np.arange(len(h), dtype=np.uint64), window - gram + 1) & place
        a, b = np.searchsorted(offsets, [lo, hi], side="right")
        cuts = np.concatenate([[lo], offsets[a:b], [hi]])  # row borders inside the step
        row = np.repeat(np.arange(a - 1, b), np.diff(cuts))[:len(at)]
        start = np.arange(lo, lo + len(at), dtype=np.int64)
        inside = start + window <= offsets[np.minimum(row + 1, len(offsets) - 1)]
        fresh = inside.copy()
        fresh[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
        done = inside.copy()
        done[:-1] &= ~inside[1:] | (at[1:] != at[:-1])
        first, last = np.flatnonzero(fresh), np.flatnonzero(done)
        # The smallest hashes crowd at the low end: mixed once more (one-to-one), ranges of them are equal shares.
        chosen = T.mix64(h[at[first].astype(np.int64)])
        found.append((start[first], start[last], chosen >> np.uint64(64 - HASH_BITS), row[first]))
    return Runs(*(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.uint64 if i == 2 else np.int64) for i in range(4)))


def _pack(values: np.ndarray) -> bytes:
    """Ascending integers as differences, by byte planes (the upper ones are nearly all zero)."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    planes = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([planes]) + steps.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    planes = blob[0]
    raw = np.frombuffer(blob, np.uint8, offset=1).reshape(planes, -1)
    steps = np.zeros((raw.shape[1], 8), dtype=np.uint8)
    steps[:, :planes] = raw.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).view(bool)


class Chunk:
    """The documents of one chunk, their runs, and what of them other documents hold."""

    def __init__(self, docs: pa.Table, cfg: tuple[int, int, int, bool]):
        self.window, self.gram, self.buckets, nulls_last = cfg
        # Every step reads the chunk anew, its rows in any order; what they send each other goes by places.
        self.docs = docs = docs.take(pc.sort_indices(docs.select(["id", "text"]).combine_chunks(), sort_keys=[("id", "ascending"), ("text", "ascending")]))
        ids = docs.column("id").combine_chunks()
        self.ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False) if len(ids) else np.zeros(0, np.int64)
        self.data, self.offsets = T.flat(docs.column("text"))
        self.runs = runs(self.data, self.offsets, self.window, self.gram)
        if ids.null_count and not nulls_last:
            own = ids.is_valid().to_numpy(zero_copy_only=False)[self.runs.row]
            self.runs = Runs(self.runs.first[own], self.runs.last[own], self.runs.hash[own], self.runs.row[own])
        self.hashes, self.which = np.unique(self.runs.hash, return_inverse=True)
        self.cuts = np.searchsorted(self.hashes, [(b << HASH_BITS) // self.buckets for b in range(self.buckets + 1)])

    def anchors(self) -> tuple[list, list]:
        """Step 1: by bucket, the hashes, and whether two documents here hold each."""
        ids = self.ids[self.runs.row]
        low, high = np.full(len(self.hashes), NO_ID), np.full(len(self.hashes), np.iinfo(np.int64).min)
        np.minimum.at(low, self.which, ids)
        np.maximum.at(high, self.which, ids)
        shared = low < high
        used = [b for b in range(self.buckets) if self.cuts[b] < self.cuts[b + 1]]
        return used, [(_pack(self.hashes[self.cuts[b]:self.cuts[b + 1]]), np.packbits(shared[self.cuts[b]:self.cuts[b + 1]]).tobytes()) for b in used]

    def stretches(self, answers: dict[int, bytes]) -> None:
        """Step 2: the distinct stretches around hashes that another document holds, in order of their hashes."""
        held = np.zeros(len(self.hashes), dtype=bool)
        for b, bits in answers.items():
            held[self.cuts[b]:self.cuts[b + 1]] = _flags(bits, self.cuts[b + 1] - self.cuts[b])
        self.picked = np.flatnonzero(held[self.which])
        first, last = self.runs.first[self.picked], self.runs.last[self.picked]
        code = T.segment_codes(self.data, first, last + self.window)
        n = int(code.max()) + 1 if len(code) else 0
        sample = np.zeros(n, np.int64)
        sample[code[::-1]] = np.arange(len(code))[::-1]  # the first of each
        order = np.argsort(self.runs.hash[self.picked][sample], kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.code, sample = place[code], sample[order]
        self.first, self.last = first[sample], last[sample]
        self.low = np.full(n, NO_ID)
        np.minimum.at(self.low, self.code, self.ids[self.runs.row[self.picked]])
        self.hash = self.runs.hash[self.picked][sample]
        self.parts = np.searchsorted(self.hash, [(b << HASH_BITS) // self.buckets for b in range(self.buckets + 1)])

    def texts(self) -> dict[str, list]:
        out: dict[str, list] = {"bucket": [], "sizes": [], "text": [], "ids": [], "hashes": []}
        for b in range(self.buckets):
            lo, hi = self.parts[b], self.parts[b + 1]
            if lo < hi:
                size = self.last[lo:hi] - self.first[lo:hi] + self.window
                out["bucket"].append(b)
                out["sizes"].append(size.astype("<u2").tobytes())
                out["text"].append(T.gather(self.data, self.first[lo:hi], size)[0].tobytes())
                out["ids"].append(self.low[lo:hi].astype("<i8").tobytes())
                out["hashes"].append(_pack(self.hash[lo:hi]))
        return out

    def covered(self, answers: dict[int, bytes]) -> np.ndarray:
        """Step 3: which bytes lie in a window that a document with a smaller id holds."""
        n = self.last - self.first + 1
        flags, at = [], np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=at[1:])
        for b in range(self.buckets):
            lo, hi = self.parts[b], self.parts[b + 1]
            if lo < hi:
                flags.append(_flags(answers[b], at[hi] - at[lo]))
        earlier = np.concatenate(flags) if flags else np.zeros(0, dtype=bool)
        starts, last = self.runs.first[self.picked], self.runs.last[self.picked]
        gone, bounds = T.gather(earlier, at[self.code], n[self.code])
        gone |= np.repeat(self.ids[self.runs.row[self.picked]] > self.low[self.code], np.diff(bounds))
        run = np.zeros(len(self.data) + 1, np.int32)
        for k in range(0, len(starts), PART):
            own = slice(k, k + PART)
            run[T.ragged(starts[own], last[own] - starts[own] + 1)[0] + 1] = gone[bounds[k]:bounds[min(k + PART, len(starts))]]
        np.cumsum(run, out=run)
        cover = run[1:].copy()  # windows from the last WINDOW places
        if len(cover) >= self.window:
            cover[self.window - 1:] -= run[:len(run) - self.window]
        return cover > 0


def _by_bucket(rows: pa.Table, step: int) -> dict[int, bytes]:
    own = rows.filter(pc.equal(rows.column("step"), step))
    return dict(zip(own.column("bucket").to_pylist(), own.column("bits").to_pylist(), strict=True))


def repeated_low(data: np.ndarray, starts: np.ndarray, ids: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix of ``data`` at ``starts``, the smallest id of those equal to it for ``depth`` bytes.

    Most-significant-digit radix order in digits of eight bytes; a group of one needs no further digit.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(shape=(len(data) + 1,), dtype=">u8", buffer=padded, strides=(1,))
    low = ids.copy()
    active, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for d in range(0, depth, 8):
        digit = words[starts[active] + d].astype(np.uint64) >> np.uint64(8 * max(0, 8 - (depth - d)))
        order = np.lexsort((digit, group))
        active, group, digit = active[order], group[order], digit[order]
        fresh = np.ones(len(active), dtype=bool)
        fresh[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        group = np.cumsum(fresh) - 1
        many = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, dtype=bool)
        active, group = active[many], group[many]
        if not len(active):
            return low
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    low[active] = np.repeat(np.minimum.reduceat(ids[active], begins), np.diff(np.append(begins, len(active))))
    return low


def _send_anchors(cfg):
    def send(docs: pa.Table) -> pa.Table:
        used, blobs = Chunk(docs, cfg).anchors()
        T.trim()
        return pa.table({"bucket": pa.array(used, pa.int64()), "chunk": pa.array([docs.column("chunk")[0].as_py()] * len(used), pa.int64()),
                         "hashes": pa.array([h for h, _ in blobs], pa.binary()), "shared": pa.array([s for _, s in blobs], pa.binary())})
    return send


def _meet_anchors(rows: pa.Table) -> pa.Table:
    lists = [_unpack(x) for x in rows.column("hashes").to_pylist()]
    sizes = [len(x) for x in lists]
    shared = np.concatenate([_flags(x, n) for x, n in zip(rows.column("shared").to_pylist(), sizes, strict=True)])
    every = np.concatenate(lists)
    order = np.argsort(every)
    same = every[order[1:]] == every[order[:-1]]
    held = shared.copy()
    held[order[1:]] |= same
    held[order[:-1]] |= same
    # a hash that one chunk alone holds, but for two documents, is held there only; the others saw it in two chunks
    at = np.cumsum([0, *sizes])
    bits = [np.packbits(held[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
    return pa.table({"chunk": rows.column("chunk"), "step": pa.array([1] * len(bits), pa.int32()), "bucket": rows.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _send_texts(cfg):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), *((c, pa.binary()) for c in ("sizes", "text", "ids", "hashes"))])
        if not len(docs):
            return schema.empty_table()
        own = Chunk(docs, cfg)
        own.stretches(_by_bucket(answers, 1))
        out = own.texts()
        T.trim()
        return pa.table(out | {"chunk": [docs.column("chunk")[0].as_py()] * len(out["bucket"])}).select(schema.names).cast(schema) if out["bucket"] else schema.empty_table()
    return send


def _earlier(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, hashes: np.ndarray, window: int) -> np.ndarray:
    """For each stretch, each of its windows: does another one with a smaller id hold it."""
    code = T.binary(data, offsets).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = int(code.max()) + 1
    low = np.full(n, NO_ID)
    np.minimum.at(low, code, ids)
    sample = np.zeros(n, np.int64)
    sample[code[::-1]] = np.arange(len(code))[::-1]
    count = (np.diff(offsets) - window + 1)[sample]
    # Only stretches that differ around the same gram can still share windows.
    mates = np.unique(hashes[sample], return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(mates[2][mates[1]] > 1)
    found = np.zeros(int(count.sum()), dtype=bool)  # by distinct stretch and window
    base = np.concatenate([[0], np.cumsum(count)])
    starts, _ = T.ragged(offsets[sample[mixed]], count[mixed])
    owner = np.repeat(low[mixed], count[mixed])
    found[T.ragged(base[mixed], count[mixed])[0]] = repeated_low(data, starts, owner, window) < owner
    return T.gather(found, base[code], count[code])[0] | np.repeat(low[code] < ids, count[code])


def _meet_texts(cfg):
    window = cfg[0]

    def meet(rows: pa.Table) -> pa.Table:
        read = lambda c, kind: [np.frombuffer(x, kind) for x in rows.column(c).to_pylist()]
        sizes = [x.astype(np.int64) for x in read("sizes", "<u2")]
        hashes = np.concatenate([_unpack(x) for x in rows.column("hashes").to_pylist()])
        size, ids, data = np.concatenate(sizes), np.concatenate(read("ids", "<i8")).astype(np.int64), np.concatenate(read("text", np.uint8))
        offsets = np.concatenate([[0], np.cumsum(size)])
        ends = np.concatenate([[0], np.cumsum(size - window + 1)])
        flags = np.zeros(ends[-1], dtype=bool)
        order = np.argsort(hashes, kind="stable")
        borders = np.flatnonzero(np.concatenate([[True], hashes[order[1:]] != hashes[order[:-1]], [True]]))
        lo = 0
        while lo < len(order):  # some hashes at a time: equal windows have equal ones
            hi = borders[min(np.searchsorted(borders, lo + PART), len(borders) - 1)]
            own = order[lo:hi]
            text, edges = T.gather(data, offsets[own], size[own])
            found = _earlier(text, edges, ids[own], hashes[own], window)
            flags[T.ragged(ends[own], size[own] - window + 1)[0]] = found
            lo = hi
        at = np.cumsum([0, *(len(x) for x in sizes)])
        T.trim()
        bits = [np.packbits(flags[ends[a]:ends[b]]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        return pa.table({"chunk": rows.column("chunk"), "step": pa.array([2] * len(bits), pa.int32()), "bucket": rows.column("bucket"), "bits": pa.array(bits, pa.binary())})
    return meet


def _cut(cfg):
    def cut(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.table({"rest": docs.column("rest"), **{c: pa.array([], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")}, "kept": pa.array([], pa.binary())})
        own = Chunk(docs, cfg)
        own.stretches(_by_bucket(answers, 1))
        gone = own.covered(_by_bucket(answers, 2))
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        first = own.offsets[:-1][own.offsets[:-1] < len(gone)]
        begins[first] |= gone[first]
        removed = T.per_segment(gone, own.offsets)
        size = np.diff(own.offsets)
        T.trim()
        kept = T.binary(own.data[~gone], np.concatenate([[0], np.cumsum(size - removed)])).cast(pa.binary())
        return pa.table({"rest": own.docs.column("rest"), "n_bytes": pa.array(size), "n_removed": pa.array(removed), "n_spans": pa.array(T.per_segment(begins, own.offsets)), "kept": kept})
    return cut


def dealt(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> tuple[DataFrame, int]:
    """``chunk``, ``id``, ``text`` and ``rest`` (a struct of the other columns) of each row, and the number of chunks.

    Equal rows share a chunk, unless they would fill one: then they are written
    once with a number each, by which they spread (and still do when a task is run again).
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), rest.alias("rest"))
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long")
    by_key = rows.select("key", size.alias("size")).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    large_key = F.when((F.col("n") > 1) & (F.col("size") > chunk_bytes), F.col("key"))
    equal = write_and_reread(by_key.groupBy(large_key.alias("key")).agg(F.sum("size").alias("size")), "repeats-sizes")
    total, large = equal.agg(F.sum("size"), F.count("key")).first()
    chunks = max(1, -(-(total or 0) // chunk_bytes))
    out = ("chunk", "id", "text", "rest")
    if not large:
        return rows.withColumn("chunk", F.pmod("key", F.lit(chunks))).select(*out), chunks
    keys = F.broadcast(equal.where("key IS NOT NULL").select("key"))  # fewer than chunks
    spread = write_and_reread(rows.join(keys, "key", "left_semi").withColumn("copy", F.monotonically_increasing_id()), "repeats-equal-rows")
    once = rows.join(keys, "key", "left_anti").withColumn("chunk", F.pmod("key", F.lit(chunks)))
    return once.select(*out).unionByName(spread.withColumn("chunk", F.pmod(F.xxhash64("key", "copy"), F.lit(chunks))).select(*out)), chunks


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES,
                   nulls_last: bool = True) -> DataFrame:
    """One row for each row of ``docs``: ``rest`` (a struct of its columns but the text), ``n_bytes``,
    ``n_removed``, ``n_spans`` and ``kept``, the remaining bytes of the text."""
    T.small_batches(docs.sparkSession)
    rows, chunks = dealt(docs, id_col, text_col, chunk_bytes)
    cfg = (window, gram, chunks, nulls_last)
    by_chunk = rows.groupBy("chunk")
    anchors = by_chunk.applyInArrow(_send_anchors(cfg), "bucket long, chunk long, hashes binary, shared binary")
    held = anchors.groupBy("bucket").applyInArrow(_meet_anchors, _ANSWER)
    texts = by_chunk.cogroup(held.groupBy("chunk")).applyInArrow(_send_texts(cfg), "bucket long, chunk long, sizes binary, text binary, ids binary, hashes binary")
    earlier = texts.groupBy("bucket").applyInArrow(_meet_texts(cfg), _ANSWER)
    schema = StructType([StructField("rest", rows.schema["rest"].dataType), *(StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")), StructField("kept", BinaryType())])
    return by_chunk.cogroup(held.unionByName(earlier).groupBy("chunk")).applyInArrow(_cut(cfg), schema)


def _whole_characters(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for kept in batches:
        yield pa.array([None if x is None else x.decode("utf-8", "ignore") for x in kept.to_pylist()], pa.string())


whole_characters = F.arrow_udf(_whole_characters, StringType())


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs``, all columns, their texts without the repeats (a character cut in two goes with them; a null text
    stays null); ``chars_col``, if there is one, is counted anew."""
    null = "_no_text"
    out = remove_repeats(docs.withColumn(null, F.col(text_col).isNull()), id_col, text_col).select("rest", whole_characters("kept").alias("kept"))
    kept = F.when(~F.col("rest")[null], F.col("kept"))
    new = {text_col: kept}
    if chars_col in docs.columns:
        new[chars_col] = F.when(F.col("rest")[null], F.col("rest")[chars_col]).otherwise(F.length("kept").cast(docs.schema[chars_col].dataType))
    return out.select(*(new.get(c, F.col("rest")[c]).alias(c) for c in docs.columns))
