"""Q5-Q8 on ad clicks, batch form. The streaming module calls the same functions.

Input: clicks ``(ts epoch-ms, area, city, userid, adid[, event_id])``. Time keys
are derived in UTC from ``ts``: ``day`` = ``yyyy-MM-dd``, minute keys keep the
date (D12). Event order is (ts, event_id) when ``event_id`` is present.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.text import day_of, minute_of, minute_text, pairs_to_json
from clickpulse.operators.topk import kth_per_group, top_k_per_group
from clickpulse.sources.adlog import event_time

DEFAULT_THRESHOLD = 100


def with_time(clicks: DataFrame) -> DataFrame:
    """Adds ``event_time`` (UTC wall clock) and ``day``."""
    t = event_time("ts")
    return clicks.withColumn("event_time", t).withColumn("day", day_of(t))


def _order_cols(clicks: DataFrame) -> list[str]:
    return ["ts"] + (["event_id"] if "event_id" in clicks.columns else [])


def user_day_ad_counts(clicks: DataFrame) -> DataFrame:
    """(day, userid, adid, clicks)."""
    return (with_time(clicks).groupBy("day", "userid", "adid")
            .agg(F.count(F.lit(1)).alias("clicks")))


def blacklist_users(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Users with at least ``threshold`` clicks on one ad in one day."""
    return (user_day_ad_counts(clicks).where(F.col("clicks") >= threshold)
            .select("userid").distinct())


def blacklist_crossings(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Per blacklisted user, the event at which the first of their (day, ad)
    counters reached ``threshold``: (userid, crossing struct of the order columns).

    The crossing of one counter is its ``threshold``-th click, found with
    ``row_number() = threshold`` -- planned as WindowGroupLimit, so a hot
    (day, user, ad) key is cut to ``threshold`` rows per task before the shuffle.
    """
    order = _order_cols(clicks)
    kth = kth_per_group(with_time(clicks), ["day", "userid", "adid"], [F.col(c) for c in order],
                        threshold)
    return kth.groupBy("userid").agg(F.min(F.struct(*order)).alias("crossing"))


def blacklist_filtered_clicks(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                              crossings: DataFrame | None = None) -> DataFrame:
    """Q5, event-order form: the clicks that pass the blacklist when every click
    is its own micro-batch. A user's clicks up to and including the crossing
    click pass; every later click of that user (any ad, any day) is dropped.

    The crossing table has at most one row per user. By default it is part of
    the plan: nothing runs and nothing is written while the query is built. A
    caller that filters the same clicks several times can write
    ``blacklist_crossings`` once, pass it as ``crossings`` and remove it
    afterwards. AQE broadcasts the table if it turns out small, else splits hot users' partitions.
    """
    order = _order_cols(clicks)
    cross = blacklist_crossings(clicks, threshold) if crossings is None else crossings
    joined = clicks.join(cross, "userid", "left")
    keep = F.col("crossing").isNull() | (F.struct(*order) <= F.col("crossing"))
    return joined.where(keep).select(*clicks.columns)


def day_area_city_ad_counts(clicks: DataFrame) -> DataFrame:
    """Q6: (day, area, city, adid, clicks) (A9 batch twin, D3 fixed)."""
    return (with_time(clicks).groupBy("day", "area", "city", "adid")
            .agg(F.count(F.lit(1)).alias("clicks")))


def day_area_ad_counts(city_counts: DataFrame) -> DataFrame:
    """Re-aggregation of Q6 to (day, area, adid, clicks)."""
    return (city_counts.groupBy("day", "area", "adid")
            .agg(F.sum("clicks").cast("long").alias("clicks")))


def day_area_ad_top3(ad_counts: DataFrame, k: int = 3) -> DataFrame:
    """Q7: top-k ads per (day, area) by clicks desc, tie-break adid (W3, D2):
    (day, area, adid, clicks, rk)."""
    return top_k_per_group(ad_counts, ["day", "area"], [F.desc("clicks"), F.asc("adid")], k)


def day_area_ad_top3_json(top3: DataFrame) -> DataFrame:
    """(day, area, top3_json) with ``top3_json`` like ``[{"2":9},{"1":5}]`` in rank
    order (A7, F12). Each list holds at most k entries."""
    ranked = F.array_sort(F.collect_list(F.struct("rk", "adid", "clicks")))
    return (top3.groupBy("day", "area").agg(ranked.alias("items"))
            .select("day", "area", pairs_to_json("items", "adid", "clicks").alias("top3_json")))


def day_top3_document(top3_json: DataFrame) -> DataFrame:
    """(day, document): one JSON object per day mapping area -> top-3 JSON text,
    areas in name order (F13, K7). Bounded by the number of areas."""
    entries = F.array_sort(F.collect_list(F.struct("area", "top3_json")))
    return (top3_json.groupBy("day")
            .agg(F.to_json(F.map_from_entries(entries)).alias("document")))


def _minute_counts(clicks: DataFrame) -> DataFrame:
    return (clicks.select("adid", minute_of(event_time("ts")).alias("minute_ts"))
            .groupBy("adid", "minute_ts").agg(F.count(F.lit(1)).alias("clicks")))


def ad_minute_trend(clicks: DataFrame, minutes: int = 60, anchor: Column | None = None) -> DataFrame:
    """Q8: clicks per (adid, minute) over the last ``minutes`` minutes (T4, D5):
    (adid, minute, clicks), ``minute`` as ``yyyy-MM-dd HH:mm``.

    The window is the ``minutes`` one-minute buckets ending with the bucket of
    ``anchor`` (default: the latest click, a scalar subquery); minute counts are
    aggregated first (partial aggregation), the window is a range filter on them.
    """
    mc = _minute_counts(clicks)
    if anchor is None:
        anchor = mc.select(F.max("minute_ts")).scalar()
    else:
        anchor = minute_of(anchor)
    lo = anchor - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return (mc.where((F.col("minute_ts") > lo) & (F.col("minute_ts") <= anchor))
            .select("adid", minute_text("minute_ts").alias("minute"), "clicks"))


def last_surviving_minute(clicks: DataFrame, crossings: DataFrame, later: int = 0) -> Column:
    """The minute of the last click that passes the blacklist, or one ``later`` minutes after it, as a scalar subquery: each user's
    last click, or, of a blacklisted user, the crossing click (which passes, and none after it). Users are joined, not clicks."""
    last = clicks.groupBy("userid").agg(F.max("ts").alias("last"))
    at = crossings.select("userid", F.col("crossing.ts").alias("crossed"))
    shift = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(later))
    return last.join(at, "userid", "left").agg((minute_of(event_time(F.max(F.coalesce("crossed", "last")))) + shift).alias("anchor")).scalar()


def ad_recent_trend(clicks: Callable[[Column | None], DataFrame], minutes: int = 60, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """``ad_minute_trend`` of the clicks that pass the blacklist, reading only its window for the trend itself (Q8).

    ``clicks(first)`` gives the clicks from ``first`` on (a wall-clock time; None: all). The crossings need every click of the
    past, by (day, user, ad); the trend's own scan gets the window's begin as a bound of the stored time, by a scalar subquery that Spark
    fills in before it opens the files, so files and row groups before it aren't read. The window ends with the last click that
    passes, so it needs no bound at its end."""
    crossings = blacklist_crossings(clicks(None), threshold)
    recent = clicks(last_surviving_minute(clicks(None), crossings, 1 - minutes))
    return (_minute_counts(blacklist_filtered_clicks(recent, threshold, crossings))
            .select("adid", minute_text("minute_ts").alias("minute"), "clicks"))


def ad_minute_trend_json(trend: DataFrame) -> DataFrame:
    """(adid, trend_json) like ``[{"2024-01-30 23:05":2},...]`` in minute order (K8)."""
    pairs = F.array_sort(F.collect_list(F.struct("minute", "clicks")))
    return (trend.groupBy("adid").agg(pairs.alias("items"))
            .select("adid", pairs_to_json("items", "minute", "clicks").alias("trend_json")))


def ad_last_hour_sliding(clicks: DataFrame, window_minutes: int = 60, slide_minutes: int = 1) -> DataFrame:
    """Sliding windows ``[start, start + window)`` with epoch-aligned starts every
    ``slide`` minutes -- the windows ``window(event_time, w, s)`` would produce
    -- with clicks per (window, adid). Output: (window_start, window_end, adid, clicks).

    Built from minute counts: each (adid, minute) count is fanned out to the
    ceil(w / s) windows containing it and re-summed, so the fan-out multiplies
    aggregated rows, not clicks. Counts are dealt by (adid, block of one window's
    length): neighbouring minutes are in one task, so its partial sums send about
    two rows per minute of the block, not one per minute and window.
    """
    mc = _minute_counts(clicks)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    em = F.timestamp_diff("MINUTE", epoch, F.col("minute_ts"))
    n = -(-window_minutes // slide_minutes)
    placed = (mc.select("adid", "clicks", em.alias("em"))
              .withColumn("block", F.floor(F.col("em") / window_minutes)).repartition("adid", "block"))
    fanned = (placed.select("adid", "clicks", "em",
                        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j"))
              .withColumn("start", F.col("em") - F.col("em") % slide_minutes - F.col("j") * slide_minutes)
              .where(F.col("start") > F.col("em") - window_minutes))
    agg = fanned.groupBy("start", "adid").agg(F.sum("clicks").cast("long").alias("clicks"))
    start_ts = F.timestamp_add("MINUTE", F.col("start"), epoch)
    end_ts = F.timestamp_add("MINUTE", F.col("start") + window_minutes, epoch)
    return agg.select(minute_text(start_ts).alias("window_start"),
                      minute_text(end_ts).alias("window_end"), "adid", "clicks")
