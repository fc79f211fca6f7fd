"""Streams on file sources with availableNow: feedback semantics, stream = batch, replay."""

import os
import shutil
import time
from collections import defaultdict

from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse.sources import AdapterTables, read_ad_stream
from clickpulse.sources.adlog import encode_ad_log
from clickpulse.streaming import (
    ad_window_counts_stream, day_area_city_ad_counts_stream, decoded_click_stream,
    start_ad_stream,
)
from tests import helpers as h
from tests.conftest import SF_SMALL


def _write_batches(folder, batches):
    """One text file per micro-batch, with increasing modification times."""
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 1000
    for i, lines in enumerate(batches):
        p = os.path.join(folder, f"part-{i:04d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (base + i, base + i))


def _run(spark, scratch, batches, threshold, **kw):
    src = os.path.join(scratch, "in")
    _write_batches(src, batches)
    lines = read_ad_stream(spark, src, max_files_per_trigger=1)
    job, q = start_ad_stream(lines, os.path.join(scratch, "state"), os.path.join(scratch, "ckpt"),
                               threshold=threshold, available_now=True, keep_rows=True, **kw)
    q.awaitTermination()
    return job, q


def _line(ts, user, ad, area="north", city="beijing"):
    return f"{h.ms(ts)},{area},{city},{user},{ad}"


def test_three_batches_blacklist_effect_from_next_batch(spark, scratch):
    b1 = [_line(f"2019-11-26 10:00:0{i}", "u1", "1") for i in range(4)] + \
         [_line(f"2019-11-26 10:00:1{i}", f"o{i}", "2") for i in range(4)]
    b2 = [_line(f"2019-11-26 10:01:0{i}", "u1", "1") for i in range(4)] + \
         [_line(f"2019-11-26 10:01:1{i}", f"o{i}", "3") for i in range(6)]
    b3 = [_line("2019-11-26 10:02:00", "u1", "1"), _line("2019-11-26 10:02:01", "u1", "2"),
          _line("2019-11-26 10:02:02", "o1", "2")]
    job, q = _run(spark, scratch, [b1, b2, b3], threshold=8)
    kept = {r.batch: r.n for r in job.survivors().groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert kept == {0: 8, 1: 10, 2: 1}
    assert [r.userid for r in job.blacklisted(2).collect()] == ["u1"]
    assert job.blacklisted(0).count() == 0 and job.blacklisted(1).count() == 1


def _brute_force_stream(batches, threshold):
    """Plain-Python model of the reference's per-batch semantics."""
    black, counts, kept = set(), defaultdict(int), []
    import datetime as dt
    for lines in batches:
        survivors = []
        for ln in lines:
            ts, area, city, user, ad = ln.split(",")[:5]
            if user not in black:
                survivors.append((int(ts), area, city, user, ad))
        for ts, area, city, user, ad in survivors:
            day = dt.datetime.fromtimestamp(ts / 1000, dt.timezone.utc).strftime("%Y-%m-%d")
            counts[(day, user, ad)] += 1
            if counts[(day, user, ad)] >= threshold:
                black.add(user)
        kept.append(survivors)
    return kept, black


def _sf_batches(spark, n_batches=4):
    clicks = op.with_time(AdapterTables(spark, SF_SMALL).clicks())
    rows = encode_ad_log(clicks, keep=("event_id", "day")).orderBy("event_id").collect()
    days = sorted({r.day for r in rows})
    cut = [days[i * len(days) // n_batches] for i in range(n_batches)] + ["9999"]
    return [[r.value for r in rows if cut[i] <= r.day < cut[i + 1]] for i in range(n_batches)]


def test_stream_matches_brute_force_on_test_data(spark, scratch):
    batches = _sf_batches(spark)
    job, q = _run(spark, scratch, batches, threshold=2)
    kept, black = _brute_force_stream(batches, 2)
    got = sorted(tuple(r)[:5] for r in job.survivors().collect())
    assert got == sorted(x for b in kept for x in b)
    assert sorted(r.userid for r in job.blacklisted(len(batches) - 1).collect()) == sorted(black)


def test_stream_equals_batch_when_nobody_crosses(spark, scratch):
    batches = _sf_batches(spark)
    job, q = _run(spark, scratch, batches, threshold=100)
    last = len(batches) - 1
    clicks = AdapterTables(spark, SF_SMALL).clicks().drop("event_id")
    want = op.day_area_city_ad_counts(clicks)
    got = job.day_area_city_ad_counts()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    # the published Q7 covers all days, whichever batch changed them last
    top3 = job.day_area_ad_top3_json()
    want7 = op.day_area_ad_top3_json(op.day_area_ad_top3(op.day_area_ad_counts(want)))
    assert sorted(map(tuple, top3.collect())) == sorted(map(tuple, want7.select(*top3.columns).collect()))
    # Q8 equals the batch trend over all clicks
    assert sorted(map(tuple, job.trend().collect())) == sorted(map(tuple, op.ad_minute_trend(clicks).collect()))
    assert job.published()["batch"] == last and q.lastProgress["stateOperators"][0]["numRowsDroppedByWatermark"] == 0
    assert "rocksdbPutCount" in q.lastProgress["stateOperators"][0]["customMetrics"]


def _files(root):
    """Every file below ``root`` but the stores' own checksums, with its bytes."""
    out = {}
    for d, _, names in os.walk(root):
        for n in names:
            if not n.endswith(".crc"):
                with open(os.path.join(d, n), "rb") as f:
                    out[os.path.relpath(os.path.join(d, n), root)] = f.read()
    return out


def _again(spark, scratch, last, **kw):
    """Run batch ``last`` again, from a copy of the checkpoint without its commit."""
    ck, ck2 = os.path.join(scratch, "ckpt"), os.path.join(scratch, f"ckpt-copy-{time.time()}")
    shutil.copytree(ck, ck2, ignore=lambda d, names: [n for n in names if d.endswith("commits") and n in (str(last), f".{last}.crc")])
    lines = read_ad_stream(spark, os.path.join(scratch, "in"), max_files_per_trigger=1)
    job, q = start_ad_stream(lines, os.path.join(scratch, "state"), ck2, available_now=True, keep_rows=True, **kw)
    q.awaitTermination()
    assert q.lastProgress is not None and q.lastProgress["batchId"] == last
    return job


def test_replay_with_the_clock_moved_on_leaves_every_file_as_it_is(spark, scratch):
    now = int(time.time() * 1000)
    edge = now + 24 * 3600 * 1000 + 90_000         # too late now, but not 90 s from now
    old = [f"{now - 7200_000 + i},north,beijing,u{i % 3},1" for i in range(9)]
    job, _ = _run(spark, scratch, [old[:4], old[4:] + [f"{edge},north,beijing,u9,1"]], threshold=3, lateness_minutes=600)
    assert [(r.value.split(",")[3], r.reason) for r in job.rejects().collect()] == [("u9", "timestamp too late")]
    before = _files(os.path.join(scratch, "state"))
    blocked = sorted(r.userid for r in job.blacklisted().collect())
    assert blocked == ["u0", "u1", "u2"]
    time.sleep(max(0, (edge - 24 * 3600 * 1000) / 1000 - time.time()) + 1)
    again = _again(spark, scratch, 1, threshold=3, lateness_minutes=600)
    assert _files(os.path.join(scratch, "state")) == before
    assert sorted(r.userid for r in again.blacklisted().collect()) == blocked


def test_replay_of_a_batch_that_failed_before_its_manifest(spark, scratch):
    batches = _sf_batches(spark, 3)
    job, _ = _run(spark, scratch, batches, threshold=2, lateness_minutes=100 * 24 * 60)
    tables = lambda j: [sorted(map(tuple, t.collect())) for t in (j.day_area_city_ad_counts(), j.day_area_ad_top3_json(), j.trend(), j.survivors(), j.blacklisted())]
    want = tables(job)
    os.remove(os.path.join(scratch, "state", "manifest", f"{2:012d}.json"))
    assert job.published()["batch"] == 1
    assert tables(_again(spark, scratch, 2, threshold=2, lateness_minutes=100 * 24 * 60)) == want


def test_late_clicks_are_kept_and_counted(spark, scratch):
    b1 = [_line("2019-11-26 10:00:00", "u1", "1"), _line("2019-11-26 12:00:30", "u2", "1")]
    b2 = [_line("2019-11-26 10:59:59", "u1", "1"), _line("2019-11-26 11:00:00", "u1", "1"), _line("2019-11-25 09:00:00", "u3", "2"), _line("2019-11-29 00:00:00", "u1", "1")]
    b3 = [_line("2019-11-28 22:00:00", "u4", "1"), _line("2019-11-28 23:30:00", "u4", "1"), "nonsense"]
    job, q = _run(spark, scratch, [b1, b2, b3], threshold=100, lateness_minutes=60)
    late = job.rejects().where("reason = 'late'")
    assert sorted(r.value for r in late.collect()) == sorted([b2[0], b2[2], b3[0]])
    assert [job.manifests.get(n)["late"] for n in range(3)] == [0, 2, 1] and job.manifests.get(2)["rejects"] == 2
    assert late.count() == sum(job.manifests.get(n)["late"] for n in range(3))
    totals = {(r.day, r.adid): r.clicks for r in job.day_area_city_ad_counts().collect()}
    assert totals == {("2019-11-26", "1"): 3, ("2019-11-29", "1"): 1, ("2019-11-28", "1"): 1}
    assert all(p["stateOperators"][0]["numRowsDroppedByWatermark"] == 0 for p in q.recentProgress if p["stateOperators"])


def test_outputs_belong_to_one_batch_and_their_folders_stay_few(spark, scratch):
    batches = [[_line(f"2019-11-{20 + n % 3} 10:{n:02d}:00", f"u{n}", str(n % 2)), _line(f"2019-11-26 10:{n:02d}:00", "u1", "1")] for n in range(9)]
    job, _ = _run(spark, scratch, batches[:5], threshold=100)
    held = job.published()
    totals = sorted(map(tuple, job.day_area_city_ad_counts(held).collect()))
    assert held["batch"] == 4 and sum(r[-1] for r in totals) == 10
    _write_batches(os.path.join(scratch, "in"), batches[:7])      # a reader holds batch 4 while two more are published
    lines = read_ad_stream(spark, os.path.join(scratch, "in"), max_files_per_trigger=1)
    job, q = start_ad_stream(lines, os.path.join(scratch, "state"), os.path.join(scratch, "ckpt"), threshold=100, available_now=True, keep_rows=True, keep_batches=2)
    q.awaitTermination()
    assert job.published()["batch"] >= 5
    assert sorted(map(tuple, job.day_area_city_ad_counts(held).collect())) == totals
    assert sum(r.clicks for r in job.day_area_city_ad_counts().collect()) == 14
    for name in os.listdir(os.path.join(job.root, "out")):
        assert len([b for b in os.listdir(os.path.join(job.root, "out", name)) if b.startswith("batch=")]) <= 4 + 2
    assert len([b for b in os.listdir(job.path("survivors")) if b.startswith("batch=")]) == 2


def test_blacklist_folders_are_put_together(spark, scratch, monkeypatch):
    from clickpulse.streaming import ad_stream
    monkeypatch.setattr(ad_stream, "MERGED", 2)
    batches = [[_line(f"2019-11-26 10:0{n}:00", f"u{n}", "1"), _line(f"2019-11-26 10:0{n}:01", f"u{max(0, n - 1)}", "1")] for n in range(6)]
    job, _ = _run(spark, scratch, batches, threshold=1)
    assert sorted(r.userid for r in job.blacklisted().collect()) == [f"u{n}" for n in range(6)]
    assert job.survivors().count() == 7                        # u0 twice in its own batch; each other user's second click is dropped
    assert len(job._numbers("feedback", "blacklist")) <= 5


def test_replay_from_copied_checkpoint_changes_nothing(spark, scratch):
    batches = _sf_batches(spark, 3)
    job, q = _run(spark, scratch, batches, threshold=2)
    before = sorted(map(tuple, job.survivors().collect()))
    # copy the checkpoint without the last commit: the last batch runs again
    ck, ck2 = os.path.join(scratch, "ckpt"), os.path.join(scratch, "ckpt-copy")
    shutil.copytree(ck, ck2, ignore=lambda d, names: [n for n in names if d.endswith("commits") and n == "2"
                                                      or d.endswith("commits") and n == ".2.crc"])
    lines = read_ad_stream(spark, os.path.join(scratch, "in"), max_files_per_trigger=1)
    job2, q2 = start_ad_stream(lines, os.path.join(scratch, "state"), ck2, threshold=2,
                                 available_now=True, keep_rows=True)
    q2.awaitTermination()
    assert q2.lastProgress is not None and q2.lastProgress["batchId"] == 2
    assert sorted(map(tuple, job2.survivors().collect())) == before


def test_native_streaming_aggregations_equal_batch(spark, scratch):
    batches = _sf_batches(spark, 2)
    src = os.path.join(scratch, "in")
    _write_batches(src, batches)
    clicks = decoded_click_stream(read_ad_stream(spark, src, max_files_per_trigger=1))
    q = (day_area_city_ad_counts_stream(clicks).writeStream.outputMode("complete").format("memory")
         .queryName("q6_stream").trigger(availableNow=True).start())
    q.awaitTermination()
    want = op.day_area_city_ad_counts(AdapterTables(spark, SF_SMALL).clicks().drop("event_id"))
    got = spark.sql("select day, area, city, adid, clicks from q6_stream")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))

    q = (ad_window_counts_stream(clicks, "60 minutes", "1 minute", watermark="100 days")
         .writeStream.outputMode("complete").format("memory").queryName("q8_stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("select date_format(window_start, 'yyyy-MM-dd HH:mm'), date_format(window_end, "
                    "'yyyy-MM-dd HH:mm'), adid, clicks from q8_stream")
    want = op.ad_last_hour_sliding(AdapterTables(spark, SF_SMALL).clicks())
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_batch_of_only_bad_lines(spark, scratch):
    b1 = [_line("2019-11-26 10:00:00", "u1", "1"), _line("2019-11-26 10:00:01", "u1", "1")]
    b2 = ["garbage", "1,2", "x,a,b,c,d"]
    b3 = [_line("2019-11-26 10:05:00", "u1", "1"), _line("2019-11-26 10:05:01", "u2", "1")]
    job, q = _run(spark, scratch, [b1, b2, b3], threshold=3)
    kept = {r.batch: r.n for r in job.survivors().groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert kept == {0: 2, 2: 2}
    rejects = spark.read.parquet(os.path.join(job.root, "rejects", "batch=1"))
    assert rejects.count() == 3 == job.rejects().count()
    assert [r.userid for r in job.blacklisted(2).collect()] == ["u1"]
    totals = {(r.day, r.adid): r.clicks for r in job.day_area_city_ad_counts().collect()}
    assert totals == {("2019-11-26", "1"): 4}


def test_processing_time_trigger(spark, scratch):
    src = os.path.join(scratch, "in")
    _write_batches(src, [[_line("2019-11-26 10:00:00", "u1", "1")], [_line("2019-11-26 10:00:01", "u2", "2")]])
    lines = read_ad_stream(spark, src, max_files_per_trigger=1)
    job, q = start_ad_stream(lines, os.path.join(scratch, "state"), os.path.join(scratch, "ckpt"),
                             threshold=100, processing_time="1 second", keep_rows=True)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert job.survivors().count() == 2
    assert {r.adid: r.clicks for r in job.day_area_city_ad_counts().collect()} \
        == {"1": 1, "2": 1}


def test_damaged_and_future_lines_do_not_stop_or_steer_the_stream(spark, scratch):
    bad = ["9223372036854775807,north,beijing,u9,1", f"{h.ms('2199-01-01 00:00:00')},north,beijing,u9,1", "1574762400000,n,c, ,1"]
    good = [_line(f"2019-11-26 10:0{i}:00", "u1", "1") for i in range(4)]
    job, q = _run(spark, scratch, [good[:2] + bad, good[2:]], threshold=100)
    assert q.exception() is None
    assert job.survivors().count() == 4
    assert sorted((r.minute, r.clicks) for r in job.trend().collect()) == [(f"2019-11-26 10:0{i}", 1) for i in range(4)]


def test_state_of_another_checkpoint_is_refused(spark, scratch):
    import pytest
    from pyspark.errors import StreamingQueryException
    _run(spark, scratch, [[_line("2019-11-26 10:00:00", "u1", "1")]], threshold=100)
    lines = read_ad_stream(spark, os.path.join(scratch, "in"), max_files_per_trigger=1)
    with pytest.raises(StreamingQueryException, match="holds the state of query"):
        start_ad_stream(lines, os.path.join(scratch, "state"), os.path.join(scratch, "other"), threshold=100, available_now=True)[1].awaitTermination()
