"""Lineage cuts that survive executor loss.

Never ``localCheckpoint`` (blocks live on executors and die with them).
Either a reliable ``checkpoint()`` into the shared ``spark.checkpoint.dir``,
or an explicit parquet table written below that folder and read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickpulse.session import checkpoint_dir, scratch_path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (eager)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_and_reread(df: DataFrame, name: str | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Materialise ``df`` as parquet in the shared folder and return a scan of it."""
    spark = spark or df.sparkSession
    path = scratch_path(spark, f"{name or 'tbl'}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
