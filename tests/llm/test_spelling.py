"""Operator 11: near words, forms and roots against all pairs; awkward texts."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from clickpulse.llm import spelling as S
from tests.llm.helpers import docs, lower, with_clashes


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts):
    out = {}
    form = {}
    for w, n in counts.items():
        around = [x for x in counts if near(w, x)]
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
        out[w] = len(around)
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, out[w], counts[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


def got(words, **how):
    return sorted((tuple(r) for r in S.group_variants(words, **how).collect()), key=repr)


def vocabulary(seed=3, n=160):
    rng = random.Random(seed)
    base = ["".join(rng.choice("aabcdeé") for _ in range(rng.randrange(5, 9))) for _ in range(n)]
    base += [w[:i] + rng.choice(["", "z", "ab"]) + w[i + 1:] for w in base for i in [rng.randrange(len(w))]]
    base += ["x" * 70, "x" * 71, "x" * 69 + "y", "y" + "x" * 69, "abcd" * 30, "abcd" * 30 + "a", "aaaaa", "aaaaaa", "aaaaaaa", "÷×÷×÷"]
    return {w: rng.randrange(3, 60) for w in base if len(w) >= 5}


@pytest.mark.parametrize("most", [20_000, 40, 3])
def test_groups_equal_all_pairs(spark, most):
    counts = vocabulary()
    words = spark.createDataFrame(list(counts.items()), "word STRING, n LONG").repartition(4)
    assert got(words, most=most) == plain(counts)


def test_a_vector_shared_by_very_many_words_is_split(spark):
    rng = random.Random(1)
    counts = {"".join(rng.sample("aabbcdef", 8)): 3 + k % 40 for k in range(300)}
    words = spark.createDataFrame(list(counts.items()), "word STRING, n LONG")
    assert got(words, most=7) == plain(counts)


def test_one_edit_is_exact():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(120)} | {"a" * 40, "a" * 41, "a" * 40 + "b", "b" + "a" * 40, "a" * 32, "a" * 33, "a" * 31 + "b"})
    letters = S.Letters([w.encode("latin-1") for w in words])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    assert S.one_edit(letters, i, letters, j).tolist() == [near(words[a], words[b]) for a, b in zip(i, j)]


def plain_words(rows):
    import re
    count = Counter()
    for d, text in rows:
        for run in re.findall(S.LETTERS, text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 3}


def test_damaged_words_of_awkward_texts(spark):
    texts = [None, "", "Élan élan ÉLAN élan_élan", "Straße straße STRASSE naïveté", "a1bcdef bcdef bcdefg-bcdef", "日本語 hello HELLO Hello", "word " * 20_000, "q" * 100_000 + " tail", "q" * 100_000, "q" * 100_000]
    many = [f"running runing run {i} letters letter letterS" for i in range(300)]
    frame = docs(spark, texts + many, extra=[(None, "running jumping jumping jumping", None, None, None), (5, "running", "en", "s", 7), (5, "running", "en", "s", 7)])
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    words = S.damaged_words(with_clashes(frame))
    assert {r.word: r.n for r in words.collect()} == plain_words(rows)
    assert got(words) == plain(plain_words(rows))


def test_chain_of_forms_ends_at_its_root(spark):
    counts = {"aaaab": 3, "aaaac": 1000, "aaabb": 7, "aabbb": 15, "abbbb": 40, "bbbbb": 100, "bbbbc": 250, "bbbcc": 600, "bbccc": 1500}
    rows = {r[0]: r for r in got(spark.createDataFrame(list(counts.items()), "word STRING, n LONG"))}
    assert rows["aaabb"][1:3] == ("aabbb", "bbccc") and rows["aaaab"][1:3] == ("aaaac", "aaaac")


def test_equal_counts_take_the_first_in_code_point_order(spark):
    counts = {"aaaaa": 3, "aaaaé": 9, "aaaaz": 9, "zaaaa": 9}
    assert {r[0]: r[1] for r in got(spark.createDataFrame(list(counts.items()), "word STRING, n LONG"))}["aaaaa"] == "aaaaz"


def test_no_words(spark):
    assert got(S.damaged_words(docs(spark, []))) == got(S.damaged_words(docs(spark, [None, "1 2 3", "abc"]))) == []
