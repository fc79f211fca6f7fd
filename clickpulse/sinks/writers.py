"""Batch writers.

Every writer is keyed so that a rerun replaces what the failed attempt wrote:
``replace_table`` overwrites, ``upsert_partitions`` overwrites only the
partitions present in the data. The outputs of the ad stream (K6-K8) go by manifests, see ``manifests``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.sources.adlog import encode_ad_log


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    """Stamp a run id on every output row (P2). The caller makes the id (one per
    run), so results stay deterministic and reruns are identifiable."""
    return df.select(F.lit(task_id).alias("task_id"), *df.columns)


def replace_table(df: DataFrame, name_or_path: str, fmt: str = "parquet",
                  partition_by: list[str] | None = None) -> None:
    """Drop-and-replace (K1): a catalog table when ``name_or_path`` has no '/', else a path."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in name_or_path:
        w.save(name_or_path)
    else:
        w.saveAsTable(name_or_path)


def upsert_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions present in ``df`` (K6: the days a batch
    touched). Values must be absolute totals, so a replay rewrites the same."""
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batchsize: int = 1000) -> None:
    """JDBC write (K3, K4): one connection and batched inserts per partition;
    columns go by name; errors propagate (defect D16)."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)


def write_ad_log(clicks: DataFrame, path: str | None = None, kafka: dict | None = None, quoted: bool = False, rejects: str | None = None) -> None:
    """Producer half of the message bus (K11): one CSV line per click, to Kafka
    (``kafka.bootstrap.servers``, ``topic``) or to text files.

    Rows that the plain format can't hold go to ``rejects`` (parquet, whole rows); without it such a row is an error
    that names it. The ``quoted`` format holds every row."""
    keep = tuple(clicks.columns)
    lines = encode_ad_log(clicks.select(F.struct(*keep).alias("_click"), *keep), keep=("_click",), quoted=quoted)
    if quoted:
        values = lines.select("value")
    elif rejects:
        lines.where("value IS NULL").select("_click.*").write.mode("overwrite").parquet(rejects)
        values = lines.where("value IS NOT NULL").select("value")
    else:
        wrong = F.raise_error(F.concat(F.lit("a field holds the delimiter or a line break: "), F.to_json("_click")))
        values = lines.select(F.coalesce("value", wrong).alias("value"))
    if kafka:
        values.write.format("kafka").options(**kafka).save()
    else:
        values.write.mode("overwrite").text(path)
