"""Operator 10: token counts at every prefix, by dynamic programming over prefixes.

For merges by score the last token of a prefix is the only piece that ends
there and stays whole beside the last token of what is before it. So one sweep
over a text gives the exact number of tokens of every one of its prefixes:
the count where that piece begins, plus one. Counts of whole texts, of
truncated texts and the longest prefix within a budget are then look-ups.

No piece crosses a space (checked when a vocabulary is loaded), so texts are
swept unit by unit (a word, the marks after it); nor does a merge join two neighbouring characters that no
piece holds side by side, so units are swept part by part. Parts are memoised with the counts at all their
prefixes, units with their total. Runs of spaces have pieces of one common, lowest score; they merge last, from the left,
and their counts repeat with the longest run's length.

Defined cases: a null or empty text has no tokens; repeated rows are all
returned; an empty table gives an empty result. The memo of a worker is emptied
at a fixed size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clickpulse.llm.merges import Merges
from clickpulse.llm.textcols import some_rows

LIMIT = 4096
MEMO_WORDS, MEMO_PARTS, MEMO_PAIRS, MEMO_CHARS = 900_000, 500_000, 1_000_000, 64
SPACE = "▁"
SCHEMA = StructType([StructField(c, LongType()) for c in ("n_bytes", "n_tokens", "fit_chars")])


class PrefixCounts:
    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        if sp.normalize("A Ａ") != f"{SPACE}A{SPACE}Ａ" or any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError(f"{path}: not a vocabulary of unnormalised text whose pieces stop at spaces")
        self.runs = {p for p in self.score if len(p) > 1 and set(p) == {SPACE}}
        words = [p for p in self.score if p not in self.runs]
        if any(p.startswith(SPACE * 2) for p in words) or {self.score[p] for p in self.runs} & {self.score[p] for p in words if len(p) > 1}:
            raise ValueError(f"{path}: runs of spaces don't merge last")
        self.automaton = ahocorasick.Automaton()
        for number, p in enumerate(words):
            self.automaton.add_word(p, (len(p), number))
        self.automaton.make_automaton()
        self.pieces = words
        place = {s: i for i, s in enumerate(sorted({-self.score[p] for p in words}))}
        self.merges = Merges({p: place[-self.score[p]] for p in words if len(p) > 1})
        self.joined = {p[i:i + 2] for p in words for i in range(len(p) - 1)}
        # Cut at C speed where no piece goes on: around characters of no piece, and between a letter and a mark that none joins to it.
        marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
        after_letter = {y for x, y in self.joined if x.isalpha()}
        cut = re.escape("".join(m for m in marks if m not in after_letter)) or "\x00"
        lone = "".join(c for c in "\n\r\t" if not any(c in pair for pair in self.joined)) or "\x00"
        more = rf"(?:[^{SPACE}{lone}{cut}]+|(?<![^\W\d_])[{cut}])*"
        self.units = re.compile(rf"[{lone}]+|(?:{SPACE}+|[{cut}]){more}|[^{SPACE}{lone}]{more}")
        self.pairs: dict[int, bool] = {}
        self.parts: dict[str, list[int]] = {}
        self.words: dict[str, int] = {}
        self.period = max(map(len, self.runs), default=1)
        self.run = [self._run(n) for n in range(4 * self.period + 1)]
        if any(self.run[n] != self.run[n - self.period] + 1 for n in range(self.period, len(self.run))):
            raise ValueError(f"{path}: runs of spaces don't repeat")

    def _run(self, n: int) -> int:
        parts = [1] * n  # equal scores: the leftmost pair that has a piece, again and again
        sizes = {len(p) for p in self.runs}
        i = 0
        while i < len(parts) - 1:
            if parts[i] + parts[i + 1] in sizes:
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                i = max(0, i - 1)
            else:
                i += 1
        return len(parts)

    def run_count(self, n: int) -> int:
        """Tokens of ``n`` spaces."""
        over = max(0, (n - self.period) // self.period)
        return self.run[n - over * self.period] + over

    def _sweep(self, part: str) -> list[int]:
        """Tokens of every prefix of a part; negative where its first character is a token of its own."""
        n = len(part)
        count, last = [0] * (n + 1), [-1] * (n + 1)
        alone = [False] * (n + 1)
        pairs, i = self.pairs, 0
        for end, (size, piece) in self.automaton.iter(part):
            end += 1
            if end == i:
                continue  # that prefix's last token is found
            while i < end - 1:  # a character without a piece: its bytes, which merge with nothing
                i += 1
                count[i], alone[i] = count[i - 1] + len(part[i - 1].encode()), i > 1 and alone[i - 1]
            j = end - size
            before = last[j]
            if before < 0:
                fits = self.merges.edges(self.pieces[piece]) is not None
            else:
                fits = pairs.get(before << 32 | piece)
                if fits is None:
                    if len(pairs) >= MEMO_PAIRS:
                        pairs.clear()
                    fits = pairs[before << 32 | piece] = self.merges.apart(self.pieces[before], self.pieces[piece])
            if fits:
                i = end
                count[i], last[i] = count[j] + 1, piece
                alone[i] = size == 1 if j == 0 else alone[j]
        while i < n:
            i += 1
            count[i], alone[i] = count[i - 1] + len(part[i - 1].encode()), i > 1 and alone[i - 1]
        return [-c if a else c for c, a in zip(count, alone, strict=True)]

    def _part(self, part: str) -> list[int]:
        """``_sweep``, memoised for short parts."""
        own = self.parts.get(part)
        if own is None:
            own = self._sweep(part)
            if len(part) <= MEMO_CHARS:
                if len(self.parts) >= MEMO_PARTS:
                    self.parts.clear()
                self.parts[part] = own
        return own

    def _cut(self, text: str) -> list[str]:
        """The parts of a text without runs of spaces: cut between characters that no piece holds side by side."""
        joined, lo, found = self.joined, 0, []
        for hi in range(1, len(text)):
            if text[hi - 1:hi + 1] not in joined:
                found.append(text[lo:hi])
                lo = hi
        found.append(text[lo:])
        return found

    def sweep(self, word: str) -> tuple[list[int], list[bool]]:
        """For a space and ``word``: tokens of every prefix (none, the space, ...), and whether the space is a token of its own there."""
        count, bare, alone = [0], [True], True
        for k, part in enumerate(self._cut(SPACE + word)):
            own, base = self._part(part), count[-1]
            count += [base + abs(c) for c in own[1:]]
            if k:
                bare += [alone] * len(part)
            else:
                bare += [c < 0 for c in own[1:]]
                alone = own[-1] < 0
        return count, bare

    def unit(self, unit: str) -> int:
        """Tokens of one unit (a run of spaces, if any, and what follows up to the next unit), memoised if short."""
        body = unit.lstrip(SPACE)
        spaces = len(unit) - len(body)
        if not body:
            n = self.run_count(spaces)
        else:
            parts = [self._part(p)[-1] for p in self._cut(SPACE + body if spaces else body)]
            n = sum(map(abs, parts))
            if spaces > 1:
                n += self.run_count(spaces) - 1 if parts[0] < 0 else self.run_count(spaces - 1)
        if len(unit) <= MEMO_CHARS:
            if len(self.words) >= MEMO_WORDS:
                self.words.clear()
            self.words[unit] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        get, make = self.words.get, self.unit
        return sum([get(u) or make(u) for u in self.units.findall(SPACE + text.replace(" ", SPACE))])

    def _unit_prefixes(self, unit: str) -> list[int]:
        """Tokens of every prefix of one unit."""
        body = unit.lstrip(SPACE)
        spaces = len(unit) - len(body)
        out = [self.run_count(i) for i in range(spaces + 1)]
        if spaces:
            counts, bare = self.sweep(body)
            alone, joined = self.run_count(spaces) - 1, self.run_count(spaces - 1)
            return out + [c + (alone if b else joined) for c, b in zip(counts[2:], bare[2:], strict=True)]
        for part in self._cut(body):
            base = out[-1]
            out += [base + abs(c) for c in self._part(part)[1:]]
        return out

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of every prefix of a text, by its number of characters."""
        out = [0]
        for unit in self.units.findall(SPACE + text.replace(" ", SPACE)):
            base = out[-1]
            out += [base + c for c in self._unit_prefixes(unit)[1:]]
        return np.array([0, *out[2:]], dtype=np.int64)  # the first space is not in the text

    def fit(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens: units add up, so only the one that
        passes the budget is looked into."""
        tokens = at = 0
        for unit in self.units.findall(SPACE + text.replace(" ", SPACE)):
            n = self.words.get(unit) or self.unit(unit)
            if tokens + n > budget:
                inside = self._unit_prefixes(unit)
                return max(0, at - 1 + max(i for i, c in enumerate(inside) if tokens + c <= budget))
            tokens, at = tokens + n, at + len(unit)
        return len(text)


@lru_cache(maxsize=4)
def prefix_counts(path: str) -> PrefixCounts:
    """One for each worker process."""
    return PrefixCounts(path)


def counter(path: str, limit: int = LIMIT):
    """A column function from text to (``n_bytes``, ``n_tokens``, ``fit_chars``: the longest prefix of ``limit`` tokens)."""
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = prefix_counts(path)
        for texts in (part for batch in batches for part in some_rows(batch)):
            rows = [t or "" for t in texts.to_pylist()]
            tokens = [own.count(t) for t in rows]
            fit = [len(t) if n <= limit else own.fit(t, limit) for t, n in zip(rows, tokens, strict=True)]
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.StructArray.from_arrays([sizes, pa.array(tokens, pa.int64()), pa.array(fit, pa.int64())], ["n_bytes", "n_tokens", "fit_chars"])
    return F.arrow_udf(count, SCHEMA)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fit_chars``."""
    c = docs.select(F.col(id_col), counter(path, limit)(F.col(text_col)).alias("c"))
    return c.select(id_col, "c.n_bytes", "c.n_tokens", (F.col("c.n_tokens") > limit).alias("over_limit"), "c.fit_chars")
