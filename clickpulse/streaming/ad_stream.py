"""The ad-click stream with blacklist feedback: one streaming query whose counts live in Spark's state store.

The plan, the same for every micro-batch ``n`` (T2, T3, T5, T6):

* lines are judged (S5); the clock of "too late" is the batch's, which the checkpoint holds, so a replay judges alike;
* users blacklisted by batches before ``n`` drop out by a left anti join with the blacklist files, a static side that
  is listed anew before each batch (``REFRESH TABLE`` on its view);
* one aggregation over three grouping sets keeps all running counts (K9, A9, minutes) in RocksDB, with changes
  written to the checkpoint; in update mode a batch puts out the keys it changed, with their totals;
* rejected lines pass through beside the counts, and so do, on request, the surviving clicks (the source is read once
  for the counts and once for each of these).

``foreachBatch`` gets that output, keeps it for the length of the call (T8) and writes, in parallel: the rejects, the users that
reached the threshold (K10), the totals of the days that changed (K6: stored totals of such a day and the changed ones), their Q7 top-3
JSON (K7) and the minutes of the Q8 trend (K8). Then the batch's manifest makes all of them visible at once, and the new
blacklisted users are put in place for the batches after ``n``. Nothing rewrites the whole state.

Late clicks: with ``lateness_minutes``, a click earlier than that behind the newest minute of the batches before goes to
the rejects with the reason ``late``, and the manifest counts it; the state store drops nothing by itself, since its own watermark
is a day behind.

Replays: Spark restores the counts as of the batch before and reads the same lines. Blacklist and clock of batches that
were not committed are set aside when the query starts, so the replay sees what the first attempt saw; a batch
that finds its manifest writes nothing, any other overwrites the folders named by its number. All paths lie under ``state_root``, a shared folder.
"""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.functions.text import day_of, minute_text
from clickpulse.operators import ads
from clickpulse.session import pin_utc
from clickpulse.sinks.files import SharedFiles
from clickpulse.sinks.manifests import Manifests
from clickpulse.sources.adlog import judge_ad_log
from clickpulse.streaming.aggregations import ad_counts_stream, use_state_store

CLICK_COLS = "ts BIGINT, area STRING, city STRING, userid STRING, adid STRING"
Q6_COLS = "area STRING, city STRING, adid STRING, clicks BIGINT"
#: How far a minute may be ahead of the batch's clock and still move the trend's window.
AHEAD_MS = 5 * 60_000
#: Blacklist folders of single batches that are put together into one (a user's row is rewritten once).
MERGED = 64


def _together(*actions) -> None:
    """Run independent Spark actions as concurrent jobs; re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=max(1, len(actions))) as pool:
        for f in [pool.submit(a) for a in actions]:
            f.result()


class AdStreamJob:
    def __init__(self, spark: SparkSession, state_root: str, threshold: int = ads.DEFAULT_THRESHOLD,
                 trend_minutes: int = 60, top_k: int = 3, lateness_minutes: int | None = None,
                 keep_rows: bool = False, keep_batches: int = 100):
        """``keep_rows``: the surviving clicks are written too, the last ``keep_batches`` batches of them."""
        self.spark, self.root, self.threshold = spark, state_root, threshold
        self.trend_minutes, self.top_k, self.lateness = trend_minutes, top_k, lateness_minutes
        self.keep_rows, self.keep_batches = keep_rows, keep_batches
        self.owned = False
        self.files, self.manifests = SharedFiles(spark), Manifests(spark, state_root)
        pin_utc(spark)
        use_state_store(spark)
        self.denied = self._feedback("blacklist", "userid STRING")
        self.clock = self._feedback("clock", "newest BIGINT")

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    # -- feedback: what a batch leaves for the plan of the next ones ------------
    def _feedback(self, name: str, schema: str) -> DataFrame:
        """The table ``feedback/<name>/batch=n``, under a view by which its files are listed anew."""
        if not self.files.exists(self.path("feedback", name, "batch=-1")):
            self.spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(self.path("feedback", name, "batch=-1"))
        table = self.spark.read.schema(f"{schema}, batch BIGINT").parquet(self.path("feedback", name))
        table.createOrReplaceTempView(self._view(name))
        return table

    def _view(self, name: str) -> str:
        return f"feedback_{name}_{id(self)}"

    def _put_in_place(self, batch: int) -> None:
        """Blacklist and clock of ``batch`` become visible to the batches after it."""
        for name in ("blacklist", "clock"):
            if self.files.exists(self.path("aside", name, f"batch={batch}")):
                self.files.move(self.path("aside", name, f"batch={batch}"), self.path("feedback", name, f"batch={batch}"))
        for old in [n for n in self._numbers("feedback", "clock") if n >= 0][:-2]:  # each carries the newest minute on; the last but one is for a replay
            self.files.delete(self.path("feedback", "clock", f"batch={old}"))
        self._merge_blacklist(batch)
        for name in ("blacklist", "clock"):
            self.spark.catalog.refreshTable(self._view(name))

    def _numbers(self, *folder: str) -> list[int]:
        return sorted(int(n.removeprefix("batch=")) for n in self.files.names(self.path(*folder)) if n.startswith("batch="))

    def _merge_blacklist(self, batch: int) -> None:
        """Folders of ``MERGED`` committed batches as one; if this ends half-way some users are there twice, which changes nothing."""
        done = int(self.files.read(self.path("merged"))) if self.files.exists(self.path("merged")) else -1
        small = [n for n in self._numbers("feedback", "blacklist") if done < n < batch]
        if len(small) < MERGED:
            return
        paths = [self.path("feedback", "blacklist", f"batch={n}") for n in small]
        merged = self.path("aside", "merged", f"batch={small[-1]}")
        self.spark.read.schema("userid STRING").parquet(*paths).hint("rebalance").write.mode("overwrite").parquet(merged)
        self.files.move(merged, paths[-1])
        self.files.write(self.path("merged"), str(small[-1]))
        for p in paths[:-1]:
            self.files.delete(p)

    def set_aside_uncommitted(self, checkpoint: str) -> None:
        """Before a start: blacklist and clock of batches after the checkpoint's last committed one are hidden from the plan."""
        owner, metadata = self.path("_owner"), os.path.join(checkpoint, "metadata")
        if not (self.files.exists(owner) and self.files.exists(metadata)) or json.loads(self.files.read(metadata))["id"] != self.files.read(owner):
            return
        done = max((int(n) for n in self.files.names(os.path.join(checkpoint, "commits")) if n.isdigit()), default=-1)
        for name in ("blacklist", "clock"):
            for n in self._numbers("feedback", name):
                if n > done:
                    self.files.move(self.path("feedback", name, f"batch={n}"), self.path("aside", name, f"batch={n}"))
            self.spark.catalog.refreshTable(self._view(name))

    def _own_state(self) -> None:
        """The state belongs to one query (a checkpoint's id): another one's batch numbers start again at 0
        and would overwrite it."""
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if self.owned or query is None:
            return
        if not self.files.exists(self.path("_owner")):
            self.files.write(self.path("_owner"), query)
        owner = self.files.read(self.path("_owner"))
        if owner != query:
            raise ValueError(f"{self.root} holds the state of query {owner}; this checkpoint's is {query}")
        self.owned = True

    # -- the streaming plan ------------------------------------------------------
    def plan(self, lines: DataFrame) -> DataFrame:
        """``kind``, ``now`` (ms, the batch's clock) and the columns of the counts, the rejects and the kept clicks."""
        judged = judge_ad_log(lines)
        if self.lateness is not None:
            # The newest minute of the batches before: one row, joined by a constant.
            newest = self.clock.agg(F.max("newest").alias("newest")).withColumn("one", F.lit(1))
            late = F.col("reason").isNull() & (F.col("ts") < F.col("newest") - self.lateness * 60_000)
            judged = (judged.withColumn("one", F.lit(1)).join(F.broadcast(newest), "one")
                      .withColumn("reason", F.when(late, F.lit("late")).otherwise(F.col("reason"))).drop("one", "newest"))
        survivors = judged.where("reason IS NULL").drop("value", "reason").join(self.denied.select("userid"), "userid", "left_anti")
        parts = [ad_counts_stream(survivors, self.lateness), judged.where("reason IS NOT NULL").select(F.lit("reject").alias("kind"), "value", "reason")]
        if self.keep_rows:
            parts.append(survivors.withColumn("kind", F.lit("row")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out.withColumn("now", F.unix_millis(F.current_timestamp()))

    # -- the foreachBatch body -----------------------------------------------------
    def process_batch(self, out: DataFrame, batch_id: int) -> None:
        self._own_state()
        if self.manifests.get(batch_id):  # done before; the state store still needs the batch to run
            out.write.format("noop").mode("overwrite").save()
        else:
            out = out.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                self._write(out, batch_id)
            finally:
                out.unpersist()
        self._put_in_place(batch_id)

    def _write(self, out: DataFrame, n: int) -> None:
        slot_ms = F.unix_millis("slot")
        day = day_of(F.col("slot"))
        crossed = (F.col("kind") == "user") & (F.col("clicks") >= self.threshold)
        late = F.col("reason") == "late"
        minute = F.col("kind") == "minute"
        # The days of one micro-batch: a handful of values (bounded by the times that lines may have).
        seen = out.agg(F.max("now").alias("now"), F.count_if(F.col("kind") == "reject").alias("rejects"), F.count_if(late).alias("late"), F.count_if(crossed).alias("crossed"),
                       F.collect_set(F.when(F.col("kind") == "area", day)).alias("days"), F.max(F.when(minute, slot_ms)).alias("newest"),
                       F.max(F.when(minute & (slot_ms <= F.col("now") + AHEAD_MS), slot_ms)).alias("anchor")).first()
        before = self.manifests.get(n - 1) or self.manifests.newest() or {"served": {}, "anchor": None, "newest": None, "minutes": None}
        days = sorted(seen["days"])
        later = lambda a, b: b if a is None else a if b is None else max(a, b)
        manifest = {"batch": n, "clock": seen["now"], "days": days, "rejects": seen["rejects"], "late": seen["late"],
                    "anchor": later(before["anchor"], seen["anchor"]), "newest": later(before["newest"], seen["newest"]),
                    "served": before["served"] | {d: n for d in days}, "minutes": n if days else before["minutes"]}
        manifest["folders"] = [f(b) for b in sorted(set(manifest["served"].values())) for f in (self._q6, self._q7)] + ([self._minutes(manifest["minutes"])] if manifest["minutes"] is not None else [])
        actions = []
        if seen["rejects"]:
            actions.append(lambda: self._save(out.where("kind = 'reject'").select("value", "reason"), "rejects", f"batch={n}"))
        if seen["crossed"]:
            actions.append(lambda: self._save(out.where(crossed).select("userid"), "aside", "blacklist", f"batch={n}"))
        if self.lateness is not None and manifest["newest"] is not None:
            actions.append(lambda: self._save(self.spark.range(1).select(F.lit(manifest["newest"]).cast("long").alias("newest")), "aside", "clock", f"batch={n}"))
        if self.keep_rows:
            actions.append(lambda: self._save(out.where("kind = 'row'").selectExpr(*[c.split()[0] for c in CLICK_COLS.split(", ")]), "survivors", f"batch={n}"))
        if days:
            totals = self._day_totals(out, days, before)
            top3 = ads.day_area_ad_top3_json(ads.day_area_ad_top3(ads.day_area_ad_counts(totals), self.top_k))
            actions += [lambda: self._save(totals, self._q6(n)), lambda: self._save(top3, self._q7(n)),
                        lambda: self._save(self._minute_totals(out, before, manifest), self._minutes(n))]
        _together(*actions)
        self.manifests.publish(manifest)
        for old in self._numbers("survivors"):
            if old <= n - self.keep_batches:
                self.files.delete(self.path("survivors", f"batch={old}"))

    # An output folder holds the days that its batch changed; the manifest says which days are still read from it.
    def _q6(self, batch: int) -> str:
        return f"out/day_area_city_ad_counts/batch={batch}"

    def _q7(self, batch: int) -> str:
        return f"out/day_area_ad_top3_json/batch={batch}"

    def _minutes(self, batch: int) -> str:
        return f"out/ad_minute_counts/batch={batch}"

    def _save(self, df: DataFrame, *where: str) -> None:
        df.hint("rebalance").write.mode("overwrite").parquet(self.path(*where))  # few files, none too large

    def _days(self, cols: str, served: dict[str, int], of) -> DataFrame:
        """The rows of some days, each from the folder that serves it."""
        out = None
        for batch in sorted(set(served.values())):
            part = self.spark.read.schema(f"day STRING, {cols}").parquet(self.path(of(batch))).where(F.col("day").isin([d for d, b in served.items() if b == batch]))
            out = part if out is None else out.unionByName(part)
        return self.spark.createDataFrame([], f"day STRING, {cols}") if out is None else out

    def _day_totals(self, out: DataFrame, days: list[str], before: dict) -> DataFrame:
        """All totals of the days that changed: the changed ones, and the stored ones that didn't."""
        changed = out.where("kind = 'area'").select(day_of(F.col("slot")).alias("day"), "area", "city", "adid", "clicks")
        stored = {d: b for d, b in before["served"].items() if d in days}
        if not stored:
            return changed
        keys = ["day", "area", "city", "adid"]
        old = self._days(Q6_COLS, stored, self._q6).join(changed.select(*keys), keys, "left_anti")
        return changed.unionByName(old.select(*changed.columns))

    def _minute_totals(self, out: DataFrame, before: dict, manifest: dict) -> DataFrame:
        """The trend's minutes, from its window on (those ahead of the clock wait there)."""
        changed = out.where("kind = 'minute'").select("adid", F.unix_millis("slot").alias("minute_ms"), "clicks")
        if before["minutes"] is not None:
            old = self.spark.read.schema("adid STRING, minute_ms BIGINT, clicks BIGINT").parquet(self.path(self._minutes(before["minutes"])))
            changed = changed.unionByName(old.join(changed.select("adid", "minute_ms"), ["adid", "minute_ms"], "left_anti").select(*changed.columns))
        if manifest["anchor"] is None:
            return changed
        return changed.where(F.col("minute_ms") > manifest["anchor"] - self.trend_minutes * 60_000)

    # -- readers: each takes the manifest it goes by (default: the newest) ----------
    def published(self, batch: int | None = None) -> dict:
        found = self.manifests.newest() if batch is None else self.manifests.get(batch)
        if found is None:
            raise ValueError(f"nothing is published under {self.root}" + (f" for batch {batch}" if batch is not None else ""))
        return found

    def day_area_city_ad_counts(self, manifest: dict | None = None) -> DataFrame:
        """Q6 totals: day, area, city, adid, clicks."""
        m = manifest or self.published()
        return self._days(Q6_COLS, m["served"], self._q6).select("day", "area", "city", "adid", "clicks")

    def day_area_ad_top3_json(self, manifest: dict | None = None) -> DataFrame:
        """Q7: day, area, top3_json."""
        m = manifest or self.published()
        return self._days("area STRING, top3_json STRING", m["served"], self._q7).select("day", "area", "top3_json")

    def trend(self, manifest: dict | None = None) -> DataFrame:
        """Q8: adid, minute, clicks of the last ``trend_minutes`` minutes, ending with the latest one that isn't ahead of the clock."""
        m = manifest or self.published()
        if m["minutes"] is None:
            return self.spark.createDataFrame([], "adid STRING, minute STRING, clicks BIGINT")
        counts = self.spark.read.schema("adid STRING, minute_ms BIGINT, clicks BIGINT").parquet(self.path(self._minutes(m["minutes"])))
        last = m["anchor"] if m["anchor"] is not None else -1
        return (counts.where((F.col("minute_ms") <= last) & (F.col("minute_ms") > last - self.trend_minutes * 60_000))
                .select("adid", minute_text(F.timestamp_millis("minute_ms")).alias("minute"), "clicks"))

    def blacklisted(self, batch_id: int | None = None) -> DataFrame:
        """Users that drop out after ``batch_id`` (default: the newest)."""
        table = self.spark.read.schema("userid STRING, batch BIGINT").parquet(self.path("feedback", "blacklist"))
        return (table if batch_id is None else table.where(F.col("batch") <= batch_id)).select("userid").distinct()

    def rejects(self) -> DataFrame:
        """value, reason, batch of all rejected lines."""
        if not self._numbers("rejects"):
            return self.spark.createDataFrame([], "value STRING, reason STRING, batch BIGINT")
        return self.spark.read.schema("value STRING, reason STRING, batch BIGINT").parquet(self.path("rejects"))

    def survivors(self) -> DataFrame:
        return self.spark.read.schema(f"{CLICK_COLS}, batch BIGINT").parquet(self.path("survivors"))


def start_ad_stream(lines: DataFrame, state_root: str, checkpoint: str, threshold: int = ads.DEFAULT_THRESHOLD,
                    processing_time: str | None = "5 seconds", available_now: bool = False, **kw):
    """Start the stream: ``lines`` is a streaming ``value`` DataFrame (Kafka or files).
    Offsets, the running counts and progress live in ``checkpoint`` (T7); tests use ``available_now``."""
    job = AdStreamJob(lines.sparkSession, state_root, threshold, **kw)
    job.set_aside_uncommitted(checkpoint)
    w = job.plan(lines).writeStream.outputMode("update").foreachBatch(job.process_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return job, w.start()
