"""Native Structured Streaming forms of the running aggregations.

These run on Spark's state store with an event-time watermark, so state for a
day (or window) is dropped once the watermark passes it (defect D13). They have
no blacklist in front; the feedback loop is ``ad_stream``, which counts with ``ad_counts_stream``
and keeps late rows apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.functions.text import day_of
from clickpulse.session import pin_utc
from clickpulse.sources.adlog import decode_ad_log

#: State on the executors' disks with changes written to the checkpoint, not whole states.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
DAY_MINUTES = 24 * 60


def use_state_store(spark: SparkSession) -> None:
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)


def decoded_click_stream(lines: DataFrame) -> DataFrame:
    """``value`` lines -> clicks with ``event_time`` and ``day``; malformed lines dropped
    (use ``decode_ad_log`` directly to keep the rejects).

    Watermarks need a zoned TIMESTAMP, so ``event_time`` is ``timestamp_millis(ts)``
    read in the session zone, which is pinned to UTC."""
    pin_utc(lines.sparkSession)
    good, _ = decode_ad_log(lines)
    t = F.timestamp_millis("ts")
    return good.withColumn("event_time", t).withColumn("day", day_of(t))


def ad_counts_stream(clicks: DataFrame, lateness_minutes: int | None = None) -> DataFrame:
    """All running counts of the ad stream from one aggregation over three grouping sets.

    ``clicks``: ts, area, city, userid, adid. Rows (update mode: the keys that a batch changed, with their totals):
    ``kind`` with ``slot`` (the day or minute) and the keys it counts by -- ``user``: day, userid, adid; ``area``: day, area, city, adid;
    ``minute``: minute, adid -- and ``clicks``. Each click is counted for its three keys before the one shuffle.

    With ``lateness_minutes`` the state of a slot goes when the newest slot is that much and a day later; the caller keeps
    clicks that are later than ``lateness_minutes`` out, so that none is dropped here uncounted."""
    t = F.timestamp_millis("ts")
    text = lambda c: F.col(c) if c else F.lit(None).cast("string")
    key = lambda kind, unit, area, city, user: F.struct(F.lit(kind).alias("kind"), F.date_trunc(unit, t).alias("slot"), text(area).alias("area"), text(city).alias("city"), text(user).alias("userid"), F.col("adid").alias("adid"))
    sets = F.array(key("user", "day", None, None, "userid"), key("area", "day", "area", "city", None), key("minute", "minute", None, None, None))
    keyed = clicks.select(F.explode(sets).alias("key")).select("key.*")
    if lateness_minutes is not None:
        keyed = keyed.withWatermark("slot", f"{lateness_minutes + DAY_MINUTES} minutes")
    return keyed.groupBy("kind", "slot", "area", "city", "userid", "adid").agg(F.count(F.lit(1)).alias("clicks"))


def day_area_city_ad_counts_stream(clicks: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Running clicks per (day, area, city, adid) (T3). Use output mode
    ``update`` (changed keys) or ``complete`` (full snapshot, as the reference)."""
    return (clicks.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 day").alias("w"), "day", "area", "city", "adid")
            .agg(F.count(F.lit(1)).alias("clicks"))
            .drop("w"))


def ad_window_counts_stream(clicks: DataFrame, window: str = "60 minutes", slide: str = "1 minute",
                            watermark: str = "10 minutes") -> DataFrame:
    """Clicks per ad in sliding event-time windows (T4): (window_start, window_end, adid, clicks)."""
    return (clicks.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", window, slide).alias("w"), "adid")
            .agg(F.count(F.lit(1)).alias("clicks"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "adid", "clicks"))
