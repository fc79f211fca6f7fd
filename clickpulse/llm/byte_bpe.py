"""Operator 7: byte-level BPE encoding and decoding in linear time.

The merges of a piece of text are the only sequence of tokens in which every
neighbouring pair is what the merges make of the two tokens' own bytes. So a
piece is encoded by taking the longest token at each place and stepping back
where a pair doesn't hold; verdicts on pairs, and whole pieces, are memoised.
Tokens are found by an Aho-Corasick automaton over the bytes as Latin-1 text.

Defined cases: a null text is empty and has no ids; repeated rows are all
returned; an empty table gives an empty result. The memos of a worker are
emptied at a fixed size, so memory doesn't grow with the corpus.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from clickpulse.llm import textcols as T
from clickpulse.llm.merges import Merges

MEMO_PIECES, MEMO_PAIRS, MEMO_BYTES = 500_000, 1_000_000, 64

#: Rows decoded at a time.
DECODED_ROWS = 512


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.pieces: dict[str, bytes] = {}
        self.merges = Merges(self.ranks)
        self.pairs: dict[int, bool] = {}
        size = max(self.tokens) + 1
        self.sizes = np.zeros(size, dtype=np.int64)
        for rank, token in self.tokens.items():
            self.sizes[rank] = len(token)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.bytes = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(size)), dtype=np.uint8)

    def holds(self, a: int, b: int) -> bool:
        """Whether the two tokens stay apart, and whole, beside each other."""
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        found = self.pairs[a << 32 | b] = self.merges.apart(self.tokens[a], self.tokens[b])
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        at: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(piece.decode("latin-1")):
            at[end + 1 - match[0]].append(match)  # ascending sizes at each start, as ends ascend
        taken: list[tuple[int, int, int]] = []  # place, number in at[place], token
        dead = bytearray(n + 1)  # places from which the rest can't be encoded
        known = self.pairs.get
        place, k, last = 0, len(at[0]) - 1, -1
        while place < n:
            here = at[place]
            while k >= 0:
                size, rank = here[k]
                if not dead[place + size]:
                    if last < 0:
                        break
                    fits = known(last << 32 | rank)
                    if self.holds(last, rank) if fits is None else fits:
                        break
                k -= 1
            if k >= 0:
                taken.append((place, k, rank))
                place, last = place + size, rank
                k = len(at[place]) - 1 if place < n else -1
            else:
                dead[place] = 1
                place, k, _ = taken.pop()
                k -= 1
                last = taken[-1][2] if taken else -1
        return [rank for _, _, rank in taken]

    def piece_ids(self, piece: str) -> bytes:
        """The ids as int32 bytes, memoised for short pieces."""
        raw = piece.encode()
        ids = np.array(self.encode_piece(raw), dtype="<i4").tobytes()
        if len(raw) <= MEMO_BYTES:
            if len(self.pieces) >= MEMO_PIECES:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        get, make = self.pieces.get, self.piece_ids
        return b"".join([get(p) or make(p) for p in self.pattern.findall(text)])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of the ids, back to back, and the offset of each id."""
        return T.gather(self.bytes, self.begins[ids], self.sizes[ids])


@lru_cache(maxsize=4)
def bpe(path: str, pattern: str) -> ByteBpe:
    """One for each worker process."""
    return ByteBpe(path, pattern)


def encoder(path: str, pattern: str):
    """A column function from text to its token ids."""
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = bpe(path, pattern)
        for texts in (part for batch in batches for part in T.some_rows(batch)):
            ids = [own.encode(t) if t else b"" for t in texts.to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            yield pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
    return F.arrow_udf(encode, ArrayType(IntegerType()))


def decoder(path: str, pattern: str):
    """A column function from token ids to their bytes."""
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = bpe(path, pattern)
        for lists in (batch.slice(i, DECODED_ROWS) for batch in batches for i in range(0, len(batch), DECODED_ROWS)):
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            out, offsets = own.decode(ids)
            yield T.binary(out, offsets[ends]).cast(pa.binary())
    return F.arrow_udf(decode, BinaryType())
