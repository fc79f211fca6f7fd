"""Small documents with every awkward case, and plain versions of what the operators compute."""

import re

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
WORD = "[^\x20\x09-\x0D]+"


def docs(spark, texts, first=0, lang="en", extra=()):
    """Rows with ids from ``first``; ``extra``: whole rows as they are."""
    rows = [(first + i, t, lang, f"src{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *extra], DOCS)


def words(text):
    return re.findall(WORD, text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


#: Columns whose names the operators use themselves.
CLASHES = ["kept", "n_words", "chunk", "id", "rest", "fp", "row", "component", "key", "bucket", "text_", "_row_key", "p", "q", "score", "lang_pred", "n_tokens"]


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES)))
