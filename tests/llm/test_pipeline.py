import random

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import test_quality, test_repeats, test_simhash
from tests.llm.helpers import docs, rows, words


def fixture():
    rng = random.Random(9)
    vocabulary = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(300)] for lang, letters in (("x", "abcdefgh"), ("y", "rstuvwxyz"))}
    prose = lambda lang, n: " ".join(rng.choice(vocabulary[lang]) for _ in range(n))
    made = [(prose(lang, rng.randint(60, 200)), lang) for lang in ("x", "y") * 40]
    passage = prose("x", 60)
    made += [(prose("x", 80) + " " + passage + " " + prose("x", 30), "x") for _ in range(3)]
    made += [(made[0][0], "x"), (made[1][0] + " end", "y"), (None, "x"), ("", "x"), ("short text", "x"), ("again and again " * 50, "x"), ("12345 " + "67890 " * 3 + " ".join(str(rng.random()) for _ in range(90)), "x")]
    return [(i, t, lang, "s", len(t or "")) for i, (t, lang) in enumerate(made)]


def test_stages_against_plain_versions(spark, tmp_path):
    made = fixture()
    docs(spark, [], extra=made).write.parquet(str(tmp_path / "documents.parquet"))
    got = rows(corpus_pipeline.run(spark, str(tmp_path)), "doc_id", "n_tokens")
    def good(text):
        c = dict(zip(test_quality.quality._COUNTS, test_quality.plain(text), strict=True))
        return c["n_words"] >= 50 and 2 * c["n_repeat_words"] <= c["n_words"]
    left = [(i, t) for i, t, *_ in made if good(t) and any(ch.isalpha() for ch in t)]
    first = {c for _, _, c in test_simhash.plain(left)}
    left = [(i, t) for i, t in left if i in first]
    cut = test_repeats.plain(left)
    assert len(cut) == len(left) and sum(c[2] for c in cut) > 0
    assert sorted(i for i, _ in got) == sorted(i for i, _ in left)
    untouched = {c[0] for c in cut if not c[2]}
    assert {i: n for i, n in got if i in untouched} == {i: len(words(t)) for i, t in left if i in untouched}
    assert all(n < len(words(dict(left)[i])) for i, n in got if i not in untouched)


def test_stage_contract_on_the_test_table(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and len(set(names)) == 5
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF_SMALL)
        assert out.columns == df.columns and out.dtypes == df.dtypes, name
        assert out.count() <= df.count()


def test_empty_table(spark, tmp_path):
    docs(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
