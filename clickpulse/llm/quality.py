"""Operator 1: quality rules by repetition coverage.

Every whole text is measured at once, in numpy: rolling hashes of the words'
codes mark the n-grams of several lengths that occur twice or more in the
text, and the rule looks at the share of word characters inside them, and
inside repeated lines. Long repeats show at every length, chance repeats of
frequent words only at the short ones.

Defined cases: a null text, an empty text and one of white space alone have no
word and so fail the base rule; a repeated row gets the same result each time;
an empty table gives an empty result. Other columns, whatever their names, are
not touched: the verdict is computed from the text column alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from clickpulse.llm import textcols as T

#: Lengths of the n-grams, and the percentage of the word characters that may lie inside repeated ones.
#: All are below the base rule's share, which any repeated n-gram counts towards.
MOST_REPEATED = {3: 30, 5: 29, 7: 28, 10: 25}
#: The same for whole lines that occur twice or more.
MOST_REPEATED_LINES = 30
#: Symbols for each 100 words.
MOST_SYMBOLS = 10
MIN_WORDS, MOST_REPEAT_WORDS = 50, 50

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
           *(f"dup_chars_{n}" for n in MOST_REPEATED))
_TYPE = pa.struct([(c, pa.int64()) for c in _COUNTS] + [("base_failed", pa.bool_()), ("kept", pa.bool_())])
SCHEMA = StructType([StructField(f.name, BooleanType() if f.type == pa.bool_() else LongType()) for f in _TYPE])


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in one of the windows of ``width`` at ``starts``."""
    edge = np.zeros(n + width + 1, dtype=np.int64)
    edge[starts] += 1
    edge[starts + width] -= 1
    return np.cumsum(edge)[:n] > 0


def _exact_triples(codes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which words lie in a window of three words that its row holds twice or more."""
    n = len(codes)
    if n < 3:
        return np.zeros(n, dtype=bool)
    k = int(codes.max()) + 1
    pairs = np.unique(codes[:-1] * k + codes[1:], return_inverse=True)[1]
    triples = pairs[:-1] * k + codes[2:]
    at = np.flatnonzero(row[:-2] == row[2:])
    keys = triples[at]
    order = np.argsort(keys, kind="stable")  # rows stay in order within a key
    a, b = order[1:], order[:-1]
    same = (keys[a] == keys[b]) & (row[at[a]] == row[at[b]])
    twice = np.zeros(len(keys), dtype=bool)
    twice[a] |= same
    twice[b] |= same
    return _covered(at[twice], 3, n)


def _lines(part: T.Slice, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By row: lines equal to an earlier one, and word characters in lines that occur twice or more.

    ``chars``: running count of word characters before each byte. Lines without a word don't count.
    """
    breaks = np.flatnonzero(part.data == 10)
    starts = np.unique(np.concatenate([part.offsets[:-1], breaks + 1]))
    starts = starts[starts < len(part.data)]
    row = np.searchsorted(part.offsets, starts, side="right") - 1
    following = np.append(breaks, len(part.data))[np.searchsorted(breaks, starts)]
    ends = np.minimum(following, part.offsets[row + 1])
    size = chars[ends] - chars[starts]
    full = size > 0
    starts, ends, row, size = starts[full], ends[full], row[full], size[full]
    codes = T.segment_codes(part.data, starts, ends)
    keys = codes * part.rows + row
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later = np.zeros(len(keys), dtype=bool)
    later[order[1:]] = same
    twice = later.copy()
    twice[order[:-1]] |= same
    return np.bincount(row[later], minlength=part.rows), np.bincount(row, size * twice, minlength=part.rows).astype(np.int64)


def measure(part: T.Slice) -> dict[str, np.ndarray]:
    """All counts of the rows of one slice."""
    w = T.words(part)
    row, n = w.row, len(w.starts)
    codes = T.segment_codes(part.data, w.starts, w.ends)
    points = ~T.WHITE[part.data] & ((part.data & 0xC0) != 0x80)
    chars = np.concatenate([[0], np.cumsum(points, dtype=np.int64)])
    length = chars[w.ends] - chars[w.starts]
    by_row = lambda mask, weight=None: np.bincount(row[mask], None if weight is None else weight[mask], minlength=part.rows).astype(np.int64)
    out = {"n_words": np.diff(w.row_offsets), "word_chars": part.per_row(points), "n_symbols": part.per_row(SYMBOLS[part.data]),
           "n_repeat_words": by_row(_exact_triples(codes, row))}
    out["n_dup_lines"], out["dup_line_chars"] = _lines(part, chars)
    rolling = T.Rolling(T.mix64(codes + 1))
    for width in MOST_REPEATED:
        h = rolling.windows(width)
        at = np.flatnonzero(row[:len(h)] == row[width - 1:]) if len(h) else np.zeros(0, dtype=np.int64)
        keys = T.mix64(h[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[f"dup_chars_{width}"] = by_row(_covered(at[_repeated(keys)], width, n), length)
    return out


def _verdict(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEAT_WORDS * c["n_words"])
    kept = ~failed & (100 * c["dup_line_chars"] <= MOST_REPEATED_LINES * c["word_chars"]) & (100 * c["n_symbols"] <= MOST_SYMBOLS * c["n_words"])
    for width, most in MOST_REPEATED.items():
        kept &= 100 * c[f"dup_chars_{width}"] <= most * c["word_chars"]
    return {"base_failed": failed, "kept": kept}


def _quality(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        parts = [measure(p) for p in T.slices(texts)]
        counts = {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in _COUNTS}
        counts |= _verdict(counts)
        yield pa.StructArray.from_arrays([pa.array(counts[f.name], type=f.type) for f in _TYPE], fields=list(_TYPE))
    T.trim()


quality_of = F.arrow_udf(_quality, SCHEMA)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its id, the counts of ``SCHEMA``, ``base_failed`` and ``kept``."""
    T.small_batches(docs.sparkSession)
    q = docs.select(F.col(id_col), quality_of(F.col(text_col)).alias("q"))
    return q.select(id_col, "q.*")


def accepted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that pass."""
    T.small_batches(docs.sparkSession)
    return docs.where(quality_of(F.col(text_col))["kept"])
