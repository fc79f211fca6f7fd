"""Operator 4: log-likelihood of whole documents by a gated recurrent language model.

Word counts cover all training rows. Documents are dealt into chunks and tokenised once: a chunk writes
its distinct words, as sorted 64-bit keys, and its documents as places in that list, from which the network is
trained and the documents are scored. A chunk also sends its words with their training
counts; a range of keys meets in one group, which adds the counts up and answers every
chunk that asked. So a very frequent word costs an entry a chunk, not an entry an occurrence, and no vocabulary is
broadcast but the ``HEAD`` most frequent words.

The network (see ``gru``) has a word layer for those; every other word, seen or
not, belongs to a class by its last two bytes, and has its count's share in it,
one unit being left for unseen words. So the probabilities of all words sum to one.
It is trained on every training row, in ``ROUNDS``: each trainer trains on the rows of its few chunks, in the order of their ids, from
the common parameters, and the parameters are averaged, weighted by tokens, by Spark. Chunks go by a hash of the rows and
are equally large whatever the corpus, so neither the input's partitions nor the number of tasks change the model.

Defined cases: a null or empty text is its end alone; repeated rows are scored
each and, in training, counted each (so many that they would fill a chunk are spread over all of them, by a number each is given
once); with no training row every count is 0 and both scores are the base formula's; an empty table gives an empty result; a very long
text is a chunk's part like any other, its state carried to its end; only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm import gru
from clickpulse.llm import textcols as T
from clickpulse.llm.repeats import _pack, _unpack, dealt
from clickpulse.plans import write_and_reread

HEAD, HEAD_CLASSES = 2048, 32
TAIL_BITS = 6
TAILS = 1 << TAIL_BITS
CHUNK_BYTES = 12 << 20
#: Chunks that one trainer trains on, one after the other.
CHUNKS_A_TRAINER = 2
#: Shares of the training rows, by a hash of the id, for one round of training each (of 16).
ROUNDS = ((0, 1), (1, 4), (4, 16))
TRAIN_LANES, SCORE_LANES = 256, 256
#: Tokens trained on at a time, and in one row of the written table.
BATCH_TOKENS, PART_TOKENS = 1_000_000, 1 << 17
BLOCKS = 64
#: Chunks to one range of keys: a range's group holds so many chunks' shares, rows are fewer than chunks by chunks.
CHUNKS_A_RANGE = 16
#: Kinds of a chunk's rows besides its documents' (by round, then those held out): its words, and what it sends to a range.
WORDS, SENT = len(ROUNDS) + 1, len(ROUNDS) + 2

_SYMBOL = T.mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
#: The end of a document: a key that no word has (its tail bits say a class that words with these bits can have, its hash is fixed).
END = np.uint64(0xE000000000000001)


def keys(part: T.Slice) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key of each word, lower-cased (its low bits are its class by its last two bytes), and the words before each row."""
    w = T.words(part)
    low = T.LOWER[part.data]
    rolling = T.Rolling(_SYMBOL[low])
    # as a rolling hash, but of each word's own length
    h = (rolling.run[w.ends] - rolling.run[w.starts]) * rolling.down[np.minimum(w.starts, max(0, len(low) - 1))]
    h = T.mix64(h + (w.ends - w.starts).astype(np.uint64))
    tail = low[w.ends - 1].astype(np.uint64) * np.uint64(256) + np.where(w.ends - w.starts > 1, low[np.maximum(w.ends - 2, 0)], 0).astype(np.uint64)
    cls = T.mix64(tail + np.uint64(1)) >> np.uint64(64 - TAIL_BITS)
    h = ((h >> np.uint64(TAIL_BITS)) << np.uint64(TAIL_BITS)) | cls
    h[h == END] ^= np.uint64(1 << 20)
    return h, w.row_offsets


def documents(texts: pa.Array, size: int = T.SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens, each row's end included, and the rows' offsets."""
    parts, counts = [], [np.zeros(1, np.int64)]
    for part in T.slices(texts, size):
        h, offsets = keys(part)
        parts.append(np.insert(h, offsets[1:], END))
        counts.append(np.diff(offsets) + 1)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.cumsum(np.concatenate(counts))


def _cuts(ordered: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(ordered, np.array([(b << 64) // buckets for b in range(buckets)] + [(1 << 64) - 1], dtype=np.uint64))


_TOKENS = "kind int, bucket long, chunk long, keys binary, counts binary, ids binary, lengths binary"


def _distinct(every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and each one's place among them (only the distinct ones are sorted)."""
    coded = pa.array(every).dictionary_encode()
    words = coded.dictionary.to_numpy()
    order = np.argsort(words)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    return words[order], place[coded.indices.to_numpy()]


def _tokenise(buckets: int):
    def tokenise(rows: pa.Table) -> pa.Table:
        col = lambda name: rows.column(name).combine_chunks()
        ids = pc.fill_null(col("id"), 0).to_numpy()
        order = np.lexsort((col("key").to_numpy(), ids, col("id").is_valid().to_numpy(zero_copy_only=False)))
        every, offsets = documents(col("text").take(pa.array(order)))
        kind = col("kind").to_numpy()[order]
        words, which = _distinct(every)
        counts = np.bincount(which[np.repeat(kind < len(ROUNDS), np.diff(offsets))], minlength=len(words)).astype(np.uint64)
        cuts = _cuts(words, buckets)
        null = pc.invert(col("id").is_valid()).to_numpy(zero_copy_only=False)[order]
        found: list[tuple] = [(WORDS, -1, _pack(words), None, None, None)]
        found += [(SENT, b, _pack(words[cuts[b]:cuts[b + 1]]), _bytes(counts[cuts[b]:cuts[b + 1]]), None, None) for b in range(buckets) if cuts[b] < cuts[b + 1]]
        for k in range(len(ROUNDS) + 1):
            own = np.flatnonzero(kind == k)
            if len(own):
                at = which[T.ragged(offsets[own], np.diff(offsets)[own])[0]]
                found.append((k, -1, None, null[own].tobytes(), ids[order][own].tobytes(), _bytes(np.diff(offsets)[own])))
                found += [(k, lo, _bytes(at[lo:lo + PART_TOKENS]), None, None, None) for lo in range(0, len(at), PART_TOKENS)]
        T.trim()
        kinds, ranges, blobs, more, names, lengths = zip(*found, strict=True)
        return pa.table({"kind": pa.array(kinds, pa.int32()), "bucket": pa.array(ranges, pa.int64()), "chunk": pa.array([col("chunk")[0].as_py()] * len(found), pa.int64()), "keys": pa.array(blobs, pa.binary()),
                         "counts": pa.array(more, pa.binary()), "ids": pa.array(names, pa.binary()), "lengths": pa.array(lengths, pa.binary())})
    return tokenise


def _pieces(rows: pa.Table) -> tuple[np.ndarray, list[dict]]:
    """A chunk's words, and its documents by kind: places of their tokens among the words, lengths, ids, which ids are null."""
    found = sorted(rows.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
    words = next(_unpack(r["keys"]) for r in found if r["kind"] == WORDS)
    return words, [{"which": np.concatenate([_ints(p["keys"]) for p in found if p["kind"] == r["kind"] and p["keys"]]), "offsets": np.concatenate([[0], np.cumsum(_ints(r["lengths"]))]),
                    "ids": np.frombuffer(r["ids"], np.int64), "null": np.frombuffer(r["counts"], bool)} for r in found if r["kind"] < WORDS and r["ids"] is not None]


def _bytes(values: np.ndarray) -> bytes:
    """Integers by byte planes."""
    values = values.astype("<u8")
    planes = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([planes]) + values.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def _ints(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8, offset=1).reshape(blob[0], -1)
    out = np.zeros((raw.shape[1], 8), dtype=np.uint8)
    out[:, :blob[0]] = raw.T
    return out.view("<u8").ravel().astype(np.int64)


_MET = "chunk long, bucket long, keys binary, counts binary"


def _meet_words(rows: pa.Table) -> pa.Table:
    """The sums, by key, for each chunk that sent it, and once for the corpus (chunk -1)."""
    lists = [_unpack(x) for x in rows.column("keys").to_pylist()]
    counts = np.concatenate([_ints(x) for x in rows.column("counts").to_pylist()])
    words, which = _distinct(np.concatenate(lists))
    total = np.bincount(which, counts, minlength=len(words)).astype(np.int64)
    at = np.cumsum([0, *map(len, lists)])
    known = total > 0
    blobs = [_bytes(total[which[a:b]]) for a, b in zip(at[:-1], at[1:], strict=True)]
    n = len(blobs)
    return pa.table({"chunk": pa.array([*rows.column("chunk").to_pylist(), -1], pa.int64()), "bucket": pa.array([rows.column("bucket")[0].as_py()] * (n + 1), pa.int64()),
                     "keys": pa.array([None] * n + [_pack(words[known]) if known.any() else b""], pa.binary()), "counts": pa.array([*blobs, _bytes(total[known])], pa.binary())})


def _top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob, counts in zip(batch.column("keys").to_pylist(), map(_ints, batch.column("counts").to_pylist()), strict=True):
            words = _unpack(blob) if blob else np.zeros(0, np.uint64)
            some = np.argsort(-counts, kind="stable")[:HEAD]
            yield pa.RecordBatch.from_pydict({"key": pa.array(words[some].view(np.int64)), "n": pa.array(counts[some])})


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob, counts in zip(batch.column("keys").to_pylist(), map(_ints, batch.column("counts").to_pylist()), strict=True):
            cls = ((_unpack(blob) if blob else np.zeros(0, np.uint64)) & np.uint64(TAILS - 1)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"cls": pa.array(np.arange(TAILS)), "n": pa.array(np.bincount(cls, counts, minlength=TAILS).astype(np.int64)), "v": pa.array(np.bincount(cls, minlength=TAILS))})


@dataclass
class Model:
    """What scoring needs besides a chunk's own counts: all of bounded size."""

    shape: gru.Shape
    params: np.ndarray
    head: np.ndarray  # keys, ascending
    place: np.ndarray  # their ids
    tail_tokens: np.ndarray  # by class, without the head
    tail_words: np.ndarray
    tokens: int
    words: int

    def ids(self, every: np.ndarray) -> np.ndarray:
        """The network's id of each token: a head word's own, or its class's."""
        at = np.minimum(np.searchsorted(self.head, every), len(self.head) - 1)
        return np.where(self.head[at] == every, self.place[at], self.shape.words + (every & np.uint64(TAILS - 1)).astype(np.int64)).astype(np.int32)


def _train(model: Model, rate: float):
    def train(rows: pa.Table) -> pa.Table:
        net, tokens = gru.Gru(model.shape, model.params), 0
        for chunk in sorted(set(rows.column("chunk").to_pylist())):
            words, pieces = _pieces(rows.filter(pc.equal(rows.column("chunk"), chunk)))
            own = model.ids(words)
            for piece in pieces:
                ids, offsets = own[piece["which"]], piece["offsets"]
                lo = 0
                while lo < len(offsets) - 1:
                    hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BATCH_TOKENS, side="right")) - 1)
                    net.train(ids[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], TRAIN_LANES, rate)
                    lo = hi
                tokens += len(ids)
        T.trim()
        blocks = np.array_split(net.flat, BLOCKS) if tokens else []
        return pa.table({"block": pa.array(range(len(blocks)), pa.int32()), "part": pa.array([rows.column("trainer")[0].as_py() % BLOCKS] * len(blocks), pa.int32()),
                         "weight": pa.array([float(tokens)] * len(blocks), pa.float64()), "params": pa.array([b.tobytes() for b in blocks], pa.binary())})
    return train


_PARAMS = "block int, part int, weight double, params binary"


def _mean(rows: pa.Table) -> pa.Table:
    weights = rows.column("weight").to_numpy()
    total = sum(w * np.frombuffer(p.as_py(), np.float32).astype(np.float64) for w, p in zip(weights, rows.column("params"), strict=True))
    return pa.table({"block": rows.column("block")[:1], "part": rows.column("part")[:1], "weight": pa.array([weights.sum()]), "params": pa.array([(total / weights.sum()).astype(np.float32).tobytes()], pa.binary())})


def fit(tokens: DataFrame, met: DataFrame, trainers: int) -> Model | None:
    """``tokens``: the chunks' documents and words; ``met``: the counted words."""
    corpus = met.where("chunk = -1").select("keys", "counts")
    top = corpus.mapInArrow(_top, "key long, n long").orderBy(F.desc("n"), "key").limit(HEAD).toArrow()
    if not len(top):
        return None
    sums = corpus.mapInArrow(_totals, "cls long, n long, v long").groupBy("cls").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).orderBy("cls").toArrow()
    found, counts = top.column("key").to_numpy().view(np.uint64), top.column("n").to_numpy()
    own = (found & np.uint64(TAILS - 1)).astype(np.int64)
    all_tokens, all_words = sums.column("n").to_numpy(), sums.column("v").to_numpy()
    tail_tokens = all_tokens - np.bincount(own, counts, minlength=TAILS).astype(np.int64)
    tail_words = all_words - np.bincount(own, minlength=TAILS)
    borders = gru.classes_by_mass(counts, HEAD_CLASSES)
    shape = gru.Shape(borders, TAILS)
    heads = np.add.reduceat(counts, borders[:-1])
    order = np.argsort(found)
    model = Model(shape, gru.start(shape, counts, np.concatenate([heads, tail_tokens])), found[order], order, tail_tokens, tail_words, int(all_tokens.sum()), int(all_words.sum()))
    for k in range(len(ROUNDS)):
        rows = tokens.where(F.col("kind").isin(k, WORDS)).withColumn("trainer", F.col("chunk") % trainers).groupBy("trainer").applyInArrow(_train(model, gru.RATE / (1 + k)), _PARAMS)
        mean = rows.groupBy("block", "part").applyInArrow(_mean, _PARAMS).groupBy("block").applyInArrow(_mean, _PARAMS)
        got = sorted(mean.select("block", "params").collect())
        if got:
            model.params = np.frombuffer(b"".join(bytes(r["params"]) for r in got), np.float32)
    return model


_SCORED = "id long, n_tokens long, n_known long, base_score double, score double"


def _score(model: Model | None, buckets: int):
    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        words, pieces = _pieces(rows)
        cuts = _cuts(words, buckets)
        count = np.zeros(len(words), np.int64)
        for b, blob in zip(answers.column("bucket").to_pylist(), answers.column("counts").to_pylist(), strict=True):
            count[cuts[b]:cuts[b + 1]] = _ints(blob)
        tokens, distinct = (model.tokens, model.words) if model else (0, 0)
        base = np.log10((count + 1.0) / (tokens + distinct + 1))
        if model:
            ids = model.ids(words)
            cls = np.maximum(ids - model.shape.words, 0)
            inside = np.where(ids < model.shape.words, 0.0, np.log10((count + 1.0) / (model.tail_tokens + model.tail_words + 1)[cls]))
            net = gru.Gru(model.shape, model.params)
        # All documents together: a long one then runs beside all others.
        which = np.concatenate([p["which"] for p in pieces])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p["offsets"]) for p in pieces]))])
        names, null = (np.concatenate([p[c] for p in pieces]) for c in ("ids", "null"))
        plain = T.per_segment(base[which], offsets, np.float64)
        total = plain
        if model:
            stream = ids[which]
            total = T.per_segment(inside[which], offsets, np.float64)
            total += net.log_likelihood([stream[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], SCORE_LANES) / np.log(10)
        known = T.per_segment((count > 0)[which], offsets)
        T.trim()
        return pa.table({"id": pa.array(names, mask=null), "n_tokens": pa.array(np.diff(offsets)), "n_known": pa.array(known), "base_score": pa.array(plain), "score": pa.array(total)})
    return score


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each row of ``docs``: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``
    (log10); learns from the rows not held out."""
    T.small_batches(docs.sparkSession)
    rows, chunks = dealt(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "id", "text", chunk_bytes)
    buckets = max(1, -(-chunks // CHUNKS_A_RANGE))
    share = F.pmod(F.xxhash64("id"), F.lit(16))
    kind = F.lit(len(ROUNDS))
    for k, (lo, hi) in enumerate(ROUNDS):
        kind = F.when(~held_out(F.col("id")) & (share >= lo) & (share < hi), k).otherwise(kind)
    shaped = rows.select("chunk", "id", "text", F.xxhash64("id", "text").alias("key"), kind.cast("int").alias("kind"))
    tokens = write_and_reread(shaped.groupBy("chunk").applyInArrow(_tokenise(buckets), _TOKENS), "lm-tokens")
    met = write_and_reread(tokens.where(F.col("kind") == SENT).select("bucket", "chunk", "keys", "counts").groupBy("bucket").applyInArrow(_meet_words, _MET), "lm-words")
    documents_of = tokens.where(F.col("kind") <= WORDS).select("kind", "bucket", "chunk", "keys", "counts", "ids", "lengths")
    model = fit(documents_of, met, -(-chunks // CHUNKS_A_TRAINER))
    answers = met.where("chunk >= 0").select("chunk", "bucket", "counts")
    scored = documents_of.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(model, buckets), _SCORED)
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens if model else 0).cast("long").alias("train_tokens"), "base_score", "score")
