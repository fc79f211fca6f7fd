"""Operator 11: grouping of spelling variants by a frequency-vector trie.

Letters are dealt to ``GROUPS`` groups of about equal use. A word's vector holds how
many of its letters each group has; words are arranged in a trie by successive
counts. One edit adds a letter to a group, takes one from a group, or moves
one, so a depth-first search that may spend a surplus and a deficit of one
each reaches every word within one edit; the words at the leaves are verified.

The trie is cut below its first levels: as many as it takes for the largest
subtree to fit a task (chosen from the counts of every prefix, one rollup). A word is indexed in its own
subtree and searches those that its first counts reach within the budget; of
the two words of a pair only the one with the smaller prefix visits the other, so each pair is met once. Subtrees are
named by a linear hash of the counts, in which a visit is one addition. A leaf that is larger still (very many words of one
vector) is split, and its visitors go to every part; nothing is left out.

Defined cases: a null or empty text has no words; a null id counts as the empty text in the damage of
``damaged_words``; letters are those of ``LETTERS``, other characters end a word; of equally frequent near
words the first in code-point order is the form; equal rows count each; very long words are compared like any
other, some at a time; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import os
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm import textcols as T
from clickpulse.plans import write_and_reread

#: Fixed values of the contract: what a run is, the least length and occurrences of a word, the share that is damaged.
LETTERS = r"[A-Za-zÀ-ÿ]+"
MIN_LETTERS, MIN_COUNT, DAMAGE, DOMINANT = 5, 3, 97, 2

GROUPS = 16
#: Words of a subtree in one task, visitors searched at a time, (word, visitor) cells and pairs of words compared at once.
SUBTREE, VISITORS, CELLS, PAIRS = 8_000, 4096, 1 << 14, 1 << 15
#: Longer words are compared one by one.
SHORT = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` (occurrences, ``MIN_COUNT`` or more) of the runs of ``docs``, A-Z lower-cased; a run of which
    ``DAMAGE`` divides the crc32 of ``id:run`` has lost the character that this number picks."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.translate(text_col, _UPPER, _LOWER), F.lit(LETTERS), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = "CAST(h % length(run) AS INT)"
    word = F.expr(f"IF(h % {DAMAGE} = 0, concat(substring(run, 1, {at}), substring(run, {at} + 2)), run)")
    words = hashed.where(F.length("run") >= MIN_LETTERS).select(word.alias("word")).where(F.length("word") >= MIN_LETTERS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters of each group: the most used letters first, each to the group used least (at most some 90 letters are met)."""
    used = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").count().collect()
    out, total = [""] * groups, [0] * groups
    for letter, n in sorted(used, key=lambda r: (-r[1], r[0])):
        g = total.index(min(total))
        out[g] += letter
        total[g] += n
    return out


def _levels(words: DataFrame, groups: list[str], most: int) -> tuple[int, bool]:
    """The first counts by which the trie is cut: the fewest with no more than ``most`` words to a subtree, else all; and
    whether a subtree is larger even so."""
    counts = [F.length("word") - F.length(F.translate("word", g, "")) if g else F.lit(0) for g in groups]
    names = [f"g{i}" for i in range(len(groups))]
    vectors = words.select(*(c.alias(n) for c, n in zip(counts, names, strict=True))).groupBy(*names).count()
    sums = vectors.rollup(*names).agg(F.sum("count").alias("words"), F.grouping_id().alias("rolled"))
    largest = {r["rolled"]: r["most"] for r in sums.groupBy("rolled").agg(F.max("words").alias("most")).collect()}
    size = lambda n: largest.get((1 << (len(groups) - n)) - 1, 0)
    levels = next((n for n in range(1, len(groups)) if size(n) <= most), len(groups))
    return levels, size(levels) > most


class Letters:
    """Words as bytes, their lengths, and the short ones as rows of a matrix, filled up with zeros."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        row = np.repeat(np.arange(len(words)), self.size)
        short = column < SHORT
        self.matrix = np.zeros((len(words), SHORT + 1), np.uint8)
        self.matrix[row[short], column[short]] = flat[short]


class Trie:
    """Words of one subtree by their vectors, in order."""

    def __init__(self, words: list[bytes], counts: list[int], table: np.ndarray):
        self.letters, self.counts = Letters(words), np.array(counts, np.int64)
        found = vectors(words, table)
        self.order = np.lexsort(found.T[::-1])
        self.vectors = found[self.order]
        self.left = _left(self.vectors)

    def near(self, visitors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, visitor) pairs whose vectors differ by a surplus and a deficit of one each at most."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        groups = self.vectors.shape[1]
        own, left = np.arange(len(visitors)), _left(visitors)
        stack = [(0, len(self.order), 0, own, np.ones(len(own), bool), np.ones(len(own), bool))]
        while stack:
            lo, hi, level, who, surplus, deficit = stack.pop()
            if level == groups or (hi - lo) * len(who) <= CELLS:
                apart = np.abs(self.vectors[lo:hi, None, level:] - visitors[None, who, level:]).sum(2, dtype=np.int32)
                more = self.left[lo:hi, None, level] - left[None, who, level]
                fits = (apart + more <= 2 * surplus) & (apart - more <= 2 * deficit)
                w, v = np.nonzero(fits)
                found.append((self.order[lo + w], who[v]))
                continue
            column = self.vectors[lo:hi, level]
            starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
            for a, b in zip(starts, np.r_[starts[1:], hi - lo], strict=True):
                gap = column[a] - visitors[who, level]
                on = (gap == 0) | (gap == 1) & surplus | (gap == -1) & deficit
                if on.any():
                    stack.append((lo + a, lo + b, level + 1, who[on], (surplus & (gap != 1))[on], (deficit & (gap != -1))[on]))
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _left(vectors: np.ndarray) -> np.ndarray:
    """The letters from each group on, and none after the last."""
    return np.pad(np.cumsum(vectors[:, ::-1], axis=1, dtype=np.int32)[:, ::-1], ((0, 0), (0, 1)))


def group_table(groups: list[str]) -> np.ndarray:
    """The group of each Latin-1 letter."""
    table = np.zeros(256, np.int64)
    for g, letters in enumerate(groups):
        for letter in letters:
            table[ord(letter)] = g
    return table


def vectors(words: list[bytes], table: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """How many letters of each group each word has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = table[np.frombuffer(b"".join(words), np.uint8)]
    row = np.repeat(np.arange(len(words)), lengths)
    return np.bincount(row * groups + letters, minlength=len(words) * groups).reshape(-1, groups).astype(np.int16 if lengths.max(initial=0) < 1 << 14 else np.int32)


def one_edit(left: Letters, i: np.ndarray, right: Letters, j: np.ndarray) -> np.ndarray:
    """Which pairs (left word i, right word j) differ by exactly one inserted, deleted or replaced letter."""
    out = np.zeros(len(i), bool)
    gap = right.size[j] - left.size[i]
    short = np.maximum(left.size[i], right.size[j]) <= SHORT
    for shift in (-1, 0, 1):
        pairs = np.flatnonzero(short & (gap == shift))
        for lo in range(0, len(pairs), PAIRS):
            part = pairs[lo:lo + PAIRS]
            a, b = left.matrix[i[part]], right.matrix[j[part]]
            differ = a != b
            if shift == 0:
                out[part] = differ.sum(1) == 1
                continue
            if shift < 0:
                a, b = b, a
            # Without the longer word's letter at the first difference, the words must be equal.
            out[part] = ~((a[:, :-1] != b[:, 1:]) & (np.arange(SHORT) >= differ.argmax(1)[:, None])).any(1)
    for k in np.flatnonzero(~short & (np.abs(gap) <= 1)).tolist():
        a, b = sorted((left.words[i[k]], right.words[j[k]]), key=len)
        same = len(os.path.commonprefix([a, b]))
        out[k] = a[same + (len(a) == len(b)):] == b[same + 1:] and a != b
    return out


def _steps(levels: int) -> np.ndarray:
    """What is added to a subtree's name to get to the later ones within the budget; each level's count has a multiplier."""
    r = T.mix64(np.arange(1, levels + 1)) | np.uint64(1)
    i, j = np.triu_indices(levels, 1)
    steps = np.concatenate([r, r[i] - r[j]])
    assert len({0, *steps.tolist(), *(~steps + np.uint64(1)).tolist()}) == 2 * len(steps) + 1  # else a pair could be met twice
    return steps


def _place(groups: list[str], levels: int):
    """Words to their own subtree (kind 0), to it as a visitor (1), and to the later ones in reach (2)."""
    table, steps = group_table(groups), _steps(levels)
    r = T.mix64(np.arange(1, levels + 1)) | np.uint64(1)
    # A step takes a letter from these levels, which must have one.
    takes = np.array([*([-1] * levels), *(j for i in range(levels) for j in range(i + 1, levels))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = [w.encode("latin-1") for w in batch.column(0).to_pylist()], batch.column(1).to_numpy()
            if not words:
                continue
            first = vectors(words, table, len(groups))[:, :levels]
            name = (first.astype(np.uint64) * r).sum(1, dtype=np.uint64)
            own = np.arange(len(words))
            who, step = np.nonzero((takes < 0) | (np.take(first, np.maximum(takes, 0), axis=1) > 0))
            rows = np.concatenate([own, own, who])
            names = np.concatenate([name, name, name[who] + steps[step]])
            kind = np.repeat(np.array([0, 1, 2], np.int8), [len(own), len(own), len(who)])
            texts = batch.column(0).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(kind), texts, pa.array(n[rows])], names=["subtree", "kind", "word", "n"])
    return place


def _search(groups: list[str]):
    table = group_table(groups)

    def found(trie: Trie, kinds: list[int], words: list[bytes], counts: list[int]) -> pa.RecordBatch:
        at, who = trie.near(vectors(words, table, len(groups)))
        # Inside its own subtree a word meets those before it (a subtree's words come in order).
        before = np.array([bisect_left(trie.letters.words, w) if kind == 1 else len(trie.order) for kind, w in zip(kinds, words, strict=True)])
        keep = at < before[who]
        at, who = at[keep], who[keep]
        visitors = Letters(words)
        near = one_edit(trie.letters, at, visitors, who)
        at, who = at[near], who[near]
        a = pa.array([trie.letters.words[i].decode("latin-1") for i in at.tolist()], pa.string())
        b = pa.array([words[i].decode("latin-1") for i in who.tolist()], pa.string())
        n = np.concatenate([np.array(counts, np.int64)[who], trie.counts[at]])
        return pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]), pa.concat_arrays([b, a]), pa.array(n, pa.int64())], names=["word", "near", "n_near"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        words: list[bytes] = []
        counts: list[int] = []
        trie: Trie | None = None
        visitors: tuple[list, list, list] = ([], [], [])

        def meet() -> Iterator[pa.RecordBatch]:
            nonlocal trie, visitors
            if words and visitors[0]:
                trie = trie or Trie(words, counts, table)
                yield found(trie, *visitors)
            visitors = ([], [], [])

        for batch in batches:
            rows = [batch.column(i).to_numpy() for i in (0, 1, 2, 4)]
            texts = [w.encode("latin-1") for w in batch.column(3).to_pylist()]
            new = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(texts)], strict=True):
                if lo == hi:
                    continue
                if (rows[0][lo], rows[1][lo]) != now:
                    yield from meet()
                    now, words, counts, trie = (rows[0][lo], rows[1][lo]), [], [], None
                own = lo + int((rows[2][lo:hi] == 0).sum())
                words += texts[lo:own]
                counts += rows[3][lo:own].tolist()
                if own < hi:
                    for kept, more in zip(visitors, (rows[2][own:hi].tolist(), texts[own:hi], rows[3][own:hi].tolist()), strict=True):
                        kept += more
                    if len(visitors[0]) >= VISITORS:
                        yield from meet()
        yield from meet()
        T.trim()
    return search


def near_words(words: DataFrame, most: int = SUBTREE) -> DataFrame:
    """``words``: word (of ``LETTERS``) and n, each word once. (``word``, ``near``, ``n_near``) of all near words, both ways."""
    groups = letter_groups(words)
    levels, large = _levels(words, groups, most)
    placed = words.select("word", "n").mapInArrow(_place(groups, levels), "subtree long, kind byte, word string, n long")
    dealt = _split(placed, most) if large else placed.withColumn("part", F.lit(0))
    ordered = dealt.repartition("subtree", "part").select("subtree", "part", "kind", "word", "n").sortWithinPartitions("subtree", "part", "kind", "word")
    return ordered.mapInArrow(_search(groups), "word string, near string, n_near long")


def _split(placed: DataFrame, most: int) -> DataFrame:
    """Subtrees of more than ``most`` words in parts, each visited by all visitors."""
    large = placed.where("kind = 0").groupBy("subtree").count().where(F.col("count") > most).select("subtree", F.ceil(F.col("count") / most).cast("int").alias("parts"))
    split = placed.join(large, "subtree", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    return split.select("subtree", F.explode(F.when(F.col("kind") == 0, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))).alias("part"), "kind", "word", "n")


def _roots(forms: DataFrame) -> DataFrame:
    """``forms``: word and form. The word at the end of each word's chain of forms, by pointer jumping: counts at least double
    along a chain, so it is at most 63 long and six rounds reach its end."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        nxt = roots.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        jumped = roots.join(nxt, "root", "left").select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("moved"))
        jumped = write_and_reread(jumped, "spelling-roots")
        roots = jumped.select("word", "root")
        if not jumped.where("moved").limit(1).count():
            return roots


def group_variants(words: DataFrame, dominant: int = DOMINANT, most: int = SUBTREE) -> DataFrame:
    """``words``: word and n, each word once. ``word``, ``form`` (its near word of largest n, if that is ``dominant`` times the
    word's), ``root`` (the end of its chain of forms), ``n``, ``n_near``, ``form_n``."""
    words = write_and_reread(words.select("word", "n"), "spelling-words")
    pairs = near_words(words, most)
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_near")).alias("less"), F.col("near").alias("near"))).alias("best"))
    has = -F.col("best.less") >= dominant * F.col("n")
    grouped = write_and_reread(words.join(best, "word", "left").select("word", F.when(has, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                                       F.when(has, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = _roots(grouped.where("form IS NOT NULL"))
    return grouped.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
