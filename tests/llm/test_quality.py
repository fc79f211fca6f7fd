import random
from collections import Counter

from clickpulse.llm import quality
from tests.llm.helpers import docs, rows, with_clashes, words


def plain(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    counts = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if counts[tuple(w[i:i + 3])] > 1 for k in range(3)}
    out = [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
           sum(sum(map(len, words(x))) for x in lines if lines.count(x) > 1)]
    for n in quality.MOST_REPEATED:
        counts = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
        inside = {i + k for i in range(len(w) - n + 1) if counts[tuple(w[i:i + n])] > 1 for k in range(n)}
        out.append(sum(len(w[i]) for i in inside))
    return out


def test_counts_equal_a_plain_version(spark):
    rng = random.Random(1)
    texts = [None, "", " \t\n", "a", "a a", "é é é é", "x\nx\n\n x\n", "\n\na b\na b", "### | a"]
    texts += ["".join(rng.choice(["a ", "b\n", "é ", "cc\t", "\n", "# "]) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(400)), "word " * 5000]
    got = {r[0]: list(r)[1:-2] for r in quality.quality_rules(docs(spark, texts)).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_verdicts_and_columns(spark):
    rng = random.Random(2)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    clean, line = fresh(300), fresh(12)
    texts = [clean, "too short", fresh(30) + " same words again" * 40, "\n".join([line] * 20), fresh(60).replace(" ", "### "), None]
    df = with_clashes(docs(spark, texts, extra=[(0, clean, None, None, None), (None, clean, None, None, None)]))
    out = quality.accepted(df)
    assert out.columns == df.columns
    assert rows(out, "doc_id") == [(0,), (0,), (None,)]
    failed = dict(rows(quality.quality_rules(df), "doc_id", "base_failed"))
    assert failed[1] and failed[2] and failed[3] and failed[5] and not failed[0] and not failed[4]
    assert quality.quality_rules(docs(spark, [])).collect() == []


def test_coverage_alone_rejects(spark):
    rng = random.Random(3)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    passage, line, triples = fresh(10), fresh(10), [fresh(3) for _ in range(6)]
    texts = [fresh(50) + "".join(f"\n{line}" for _ in range(5)),  # half of the words: the base rule accepts it
             " ".join(x for _ in range(3) for x in (fresh(20), passage)),  # one third, in 10-grams
             " ".join(x for t in triples * 2 for x in (fresh(4), t)),  # 36 of 84 words, in 3-grams
             fresh(90) + f" {passage} " + fresh(1) + f" {passage}",  # 20 of 111 words
             fresh(100)]
    got = quality.quality_rules(docs(spark, texts))
    assert rows(got, "doc_id", "base_failed") == [(i, False) for i in range(5)]
    assert all(n == 0 for (n,) in rows(got, "n_symbols"))
    assert rows(got.where("kept"), "doc_id") == [(3,), (4,)]
    assert rows(quality.accepted(docs(spark, texts)), "doc_id") == [(3,), (4,)]


def test_lines_of_words_joined_by_bars_are_rejected(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    menu = "\n".join(" ".join(word() for _ in range(6)) + " | " + word() for _ in range(20))  # 20 symbols for 160 words
    prose = " ".join(word() for _ in range(150)) + " 5% & 7% of $10 | more" + "".join(f" {word()}" for _ in range(40))
    got = quality.quality_rules(docs(spark, [menu, menu.replace(" | ", " "), prose]))
    assert rows(got, "doc_id", "n_symbols", "base_failed") == [(0, 20, False), (1, 0, False), (2, 5, False)]
    assert rows(got.where("kept"), "doc_id") == [(1,), (2,)]
