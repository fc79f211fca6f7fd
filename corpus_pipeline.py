"""From raw documents to packed batches: a chain of the operators in ``clickpulse.llm``.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickpulse.llm import language, packing, quality, repeats, simhash
from clickpulse.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return quality.accepted(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised; learned from the labels of these documents."""
    return language.accepted(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the byte strings that an earlier one has."""
    return repeats.without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's bucket and batch."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("suffix_array_dedup", repeats_stage),
    ("packing", packing_stage),
]

#: A trained classifier and a byte-wise suffix sort are not SQL: tests hold ``run`` against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder before the next stage reads it."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}-{name}"
        stage(spark, out, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
    return out
