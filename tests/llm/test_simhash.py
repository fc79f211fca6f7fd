import random

import numpy as np
import xxhash

from clickpulse.llm import graph, simhash
from tests.llm.helpers import docs, lower, rows, with_clashes, words


def fingerprint(text):
    w = words(lower(text))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(vertices, edges):
    up = {v: v for v in vertices}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        up[root(a)] = root(b)
    groups = {}
    for v in vertices:
        groups.setdefault(root(v), []).append(v)
    return groups.values()


def plain(items):
    fps = [(i, fingerprint(t)) for i, t in items]
    edges = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a][1] ^ fps[b][1]).bit_count() <= 2]
    out = []
    for g in classes(range(len(fps)), edges):
        ids = [fps[k][0] for k in g if fps[k][0] is not None]
        out += [(fps[k][0], f"{fps[k][1]:016x}", min(ids, default=None)) for k in g]
    return sorted(out, key=repr)


def sample():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(60)]
    text = lambda: " ".join(rng.choice(base) for _ in range(80))
    long = text()
    near = [long.replace(f" {w} ", " other ", 1) for w in base[:15]]
    return [None, "", "  ", "One", "one", "one two", "One  two\nTHREE", "one two three four", long, long.upper(), *near, *[text() for _ in range(20)], long]


def test_against_plain_version(spark):
    items = list(enumerate(sample())) + [(3, "One"), (None, "one")]
    df = spark.createDataFrame(items, "doc_id LONG, text STRING")
    assert rows(simhash.near_duplicates(df)) == plain(items)
    assert simhash.near_duplicates(docs(spark, [])).collect() == []


def test_links_are_whole_with_and_without_wildcard_pairs(spark):
    rng = np.random.default_rng(1)
    found = []
    for centre in rng.integers(0, 1 << 63, 3).tolist():
        for _ in range(70):
            x = centre
            for bit in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                x ^= 1 << bit
            found.append(x)
    fps = sorted(set(np.array(found, dtype=np.uint64).view(np.int64).tolist()))
    want = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    df = spark.createDataFrame([(x,) for x in fps], "fp LONG")
    for heavy in (2, 256):
        assert {tuple(r) for r in simhash.links(df, heavy).collect()} == want


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)] + [(-5, 7)]
    random.Random(4).shuffle(edges)
    got = dict(rows(graph.connected_components(spark.createDataFrame(edges, "a LONG, b LONG").repartition(7))))
    want = {v: min(g) for g in classes({v for e in edges for v in e}, edges) for v in g if v != min(g)}
    assert got == want
    assert graph.connected_components(spark.createDataFrame([], "a LONG, b LONG")).collect() == []


def test_one_of_each_keeps_all_columns(spark):
    texts = sample()
    df = with_clashes(docs(spark, texts, extra=[(3, "One", None, None, None)]))
    out = simhash.one_of_each(df)
    assert out.columns == df.columns
    want = {c for _, _, c in plain([*enumerate(texts), (3, "One")])}
    assert [r[0] for r in rows(out, "doc_id")] == sorted(want, key=repr) or sorted(r[0] for r in rows(out, "doc_id")) == sorted(want)


def test_the_kept_row_does_not_depend_on_the_order_of_rows(spark):
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(["first", *words[1:]])]
    made = [(5, t, "en", "s", 1) for t in texts]
    kept = [[r.text for r in simhash.one_of_each(docs(spark, [], extra=x)).collect()] for x in (made, made[::-1])]
    assert kept[0] == kept[1]

