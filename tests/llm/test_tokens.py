import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from clickpulse.llm import byte_bpe, registry, token_counts
from clickpulse.llm.merges import Merges
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs, rows, with_clashes

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [" ", "  ", "a", "the", "▁", "\t", "\n", "é", "日", "😀", "Ａ", "<s>", "</s>", "<0x41>", ".", ",", "tion", "in", "   ", "​", "ing ",
       "▁▁", "ß", "é", '"', "-", "1", "23", "'s", "'ll", "thththth", "zzzz", "\x1c", "\x85", "\xa0", "<|endoftext|>"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.bpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def counts():
    return token_counts.prefix_counts(PIECES)


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_encoding_equals_the_library_and_decodes(bpe, tik):
    for t in [*odd_texts(4000, 1), "a" * 3000, " " * 3000, "ab" * 2000, "thing" * 1000, "\n" * 500 + "x"]:
        ids = np.frombuffer(bpe.encode(t), "<i4")
        assert ids.tolist() == tik.encode_ordinary(t), t
        assert bpe.decode(ids)[0].tobytes() == t.encode()


def test_every_token_alone(bpe, tik):
    for rank, token in list(bpe.tokens.items())[::37]:
        assert bpe.encode_piece(token) == [tik.encode_single_token(token)]


def test_tokens_apart_equal_the_merges(bpe):
    rng, m = random.Random(2), Merges(bpe.ranks)
    known = list(bpe.ranks)
    for _ in range(3000):
        a, b = rng.choice(known), rng.choice(known)
        assert m.apart(a, b) == ([x[0] for x in m.merge(a + b)] == [a, b]), (a, b)


def test_byte_bpe_query(spark, tik):
    got = {r.doc_id: r for r in registry.op7_byte_bpe(spark, SF_SMALL).collect()}
    for d in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = tik.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest())


def test_byte_bpe_awkward_rows(spark, tik):
    encode, decode = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN), byte_bpe.decoder(RANKS, public_tokenizers.PATTERN)
    df = with_clashes(docs(spark, [None, "", "é 😀", "word " * 40_000, "é 😀"]))
    got = {r[0]: (r[1], bytes(r[2])) for r in df.select("doc_id", encode("text").alias("ids")).select("doc_id", "ids", decode("ids")).collect()}
    for i, t in enumerate([None, "", "é 😀", "word " * 40_000, "é 😀"]):
        assert got[i] == (tik.encode_ordinary(t or ""), (t or "").encode())
    assert docs(spark, []).select(encode("text")).collect() == []


def test_counts_equal_the_library(counts, sp):
    for t in odd_texts(4000, 3):
        assert counts.count(t) == len(sp.encode(t)), t
    for n in range(120):
        for t in (" " * n, " " * n + "a", "x" + " " * n + "\t", "a" * n):
            assert counts.count(t) == len(sp.encode(t)), t


def test_prefixes_equal_encoding_each_prefix(counts, sp):
    for t in odd_texts(400, 4):
        want = [len(sp.encode(t[:i])) for i in range(len(t) + 1)]
        assert counts.prefixes(t).tolist() == want, t
        for budget in (0, 1, 3, 100):
            assert counts.fit(t, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_token_count_rows(spark, sp):
    texts = [None, "", "é", "token " * 9000, " " * 9000, "token " * 9000]
    got = rows(token_counts.count_tokens(with_clashes(docs(spark, texts)), PIECES))
    for i, n_bytes, n_tokens, over, fit in got:
        t = texts[i] or ""
        assert (n_bytes, n_tokens, over) == (len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 4096)
        assert len(sp.encode(t[:fit])) <= 4096 and (fit == len(t) or len(sp.encode(t[:fit + 1])) > 4096)
    assert len(got) == 6 and token_counts.count_tokens(docs(spark, []), PIECES).collect() == []
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {d.doc_id: len(sp.encode(d.text)) for d in real.collect()}
    assert dict(rows(token_counts.count_tokens(real, PIECES), "doc_id", "n_tokens")) == want
