"""Hand fixtures for the ad-click analyses."""

from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse.sources.adlog import decode_ad_log, encode_ad_log
from tests import helpers as h


def test_ad_lines_bad(spark):
    lines = spark.createDataFrame([("1574750000000,north,beijing,3,5",), ("1574750000000,north,beijing",),
                                   ("x,north,beijing,3,5",), ("",), (None,),
                                   ("1574750000001,south,sz,4,6,extra",)], "value string")
    good, bad = decode_ad_log(lines)
    assert sorted(tuple(r) for r in good.collect()) == [
        (1574750000000, "north", "beijing", "3", "5"), (1574750000001, "south", "sz", "4", "6")]
    reasons = sorted((r.value, r.reason) for r in bad.collect() if r.value is not None)
    assert reasons == [("", "bad timestamp"), ("1574750000000,north,beijing", "too few fields"),
                       ("x,north,beijing,3,5", "bad timestamp")]
    assert bad.count() == 4


def test_encode_decode_roundtrip(spark):
    c = h.clicks(spark, [(h.ms("2019-11-26 10:00:00"), "north", "beijing", "3", "5")], with_id=False)
    lines = encode_ad_log(c)
    assert lines.first().value == f"{h.ms('2019-11-26 10:00:00')},north,beijing,3,5"
    good, bad = decode_ad_log(lines)
    assert good.collect() == c.collect() and bad.count() == 0


def _click_rows(user, ad, day, n, start_sec=0, area="north", city="beijing"):
    return [(h.ms(f"{day} 10:{(start_sec + i) // 60 % 60:02d}:{(start_sec + i) % 60:02d}"), area, city, user, ad)
            for i in range(n)]


def test_threshold_edge(spark):
    rows = (_click_rows("u99", "1", "2019-11-26", 99)            # 99: stays
            + _click_rows("u100", "1", "2019-11-26", 100)        # 100: blacklisted at the 100th
            + _click_rows("u101", "1", "2019-11-26", 101)        # 101: the 101st click is dropped
            + _click_rows("u2ads", "1", "2019-11-26", 50) + _click_rows("u2ads", "2", "2019-11-26", 50, 50)
            + _click_rows("u2days", "1", "2019-11-26", 50) + _click_rows("u2days", "1", "2019-11-27", 50))
    c = h.clicks(spark, rows)
    assert sorted(r.userid for r in op.blacklist_users(c, 100).collect()) == ["u100", "u101"]
    kept = {r.userid: r.n for r in op.blacklist_filtered_clicks(c, 100).groupBy("userid")
            .agg(F.count("*").alias("n")).collect()}
    assert kept == {"u99": 99, "u100": 100, "u101": 100, "u2ads": 100, "u2days": 100}


def test_crossing_drops_later_clicks_on_every_ad_and_day(spark):
    rows = (_click_rows("u", "1", "2019-11-26", 3)                # crosses at its 3rd click (threshold 3)
            + _click_rows("u", "2", "2019-11-26", 2, 10)          # later, other ad: dropped
            + _click_rows("u", "2", "2019-11-27", 1)              # later day: dropped
            + _click_rows("v", "1", "2019-11-26", 2))
    c = h.clicks(spark, rows)
    kept = sorted((r.userid, r.adid) for r in op.blacklist_filtered_clicks(c, 3).collect())
    assert kept == [("u", "1")] * 3 + [("v", "1")] * 2


def test_earlier_clicks_on_other_ads_survive(spark):
    # clicks on ad 2 before the crossing on ad 1 survive
    rows = (_click_rows("u", "2", "2019-11-26", 2) + _click_rows("u", "1", "2019-11-26", 3, 10)
            + _click_rows("u", "2", "2019-11-26", 1, 30))
    c = h.clicks(spark, rows)
    kept = sorted(r.adid for r in op.blacklist_filtered_clicks(c, 3).collect())
    assert kept == ["1", "1", "1", "2", "2"]


def test_two_days_same_minute_are_separate(spark):
    rows = [(h.ms("2019-11-26 10:05:10"), "n", "c", "1", "7"), (h.ms("2019-11-27 10:05:20"), "n", "c", "1", "7"),
            (h.ms("2019-11-27 10:05:40"), "n", "c", "1", "7")]
    c = h.clicks(spark, rows)
    got = sorted(tuple(r) for r in op.ad_minute_trend(c, minutes=3000).collect())
    assert got == [("7", "2019-11-26 10:05", 1), ("7", "2019-11-27 10:05", 2)]
    # the default last hour only sees the latest day
    assert [tuple(r) for r in op.ad_minute_trend(c).collect()] == [("7", "2019-11-27 10:05", 2)]


def test_minute_trend_json_and_sliding(spark):
    rows = [(h.ms("2019-11-26 10:00:10"), "n", "c", "1", "7"), (h.ms("2019-11-26 10:01:10"), "n", "c", "1", "7"),
            (h.ms("2019-11-26 10:01:20"), "n", "c", "1", "8")]
    c = h.clicks(spark, rows)
    js = {r.adid: r.trend_json for r in op.ad_minute_trend_json(op.ad_minute_trend(c)).collect()}
    assert js == {"7": '[{"2019-11-26 10:00":1},{"2019-11-26 10:01":1}]', "8": '[{"2019-11-26 10:01":1}]'}
    sl = sorted(tuple(r) for r in op.ad_last_hour_sliding(c, 2, 1).collect())
    assert sl == [("2019-11-26 09:59", "2019-11-26 10:01", "7", 1),
                  ("2019-11-26 10:00", "2019-11-26 10:02", "7", 2),
                  ("2019-11-26 10:00", "2019-11-26 10:02", "8", 1),
                  ("2019-11-26 10:01", "2019-11-26 10:03", "7", 1),
                  ("2019-11-26 10:01", "2019-11-26 10:03", "8", 1)]


def test_sliding_matches_spark_window(spark):
    rows = [(h.ms(f"2019-11-26 10:{m:02d}:{s:02d}"), "n", "c", "1", str(a))
            for m, s, a in [(0, 1, 1), (0, 59, 1), (3, 0, 2), (7, 30, 1), (9, 59, 2), (10, 0, 1)]]
    c = op.with_time(h.clicks(spark, rows))
    for w, s in [(5, 1), (4, 2), (3, 3)]:
        ours = sorted(tuple(r) for r in op.ad_last_hour_sliding(c, w, s).collect())
        ref = (c.groupBy(F.window("event_time", f"{w} minutes", f"{s} minutes").alias("w"), "adid")
               .agg(F.count("*").alias("clicks"))
               .select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("a"),
                       F.date_format("w.end", "yyyy-MM-dd HH:mm").alias("b"), "adid", "clicks"))
        assert ours == sorted(tuple(r) for r in ref.collect()), (w, s)


def test_top3_order_ties_and_json(spark):
    counts = spark.createDataFrame(
        [("2019-11-26", "north", "1", 5), ("2019-11-26", "north", "2", 9), ("2019-11-26", "north", "3", 5),
         ("2019-11-26", "north", "4", 1), ("2019-11-26", "south", "2", 2), ("2019-11-27", "north", "1", 1)],
        "day string, area string, adid string, clicks bigint")
    top = op.day_area_ad_top3(counts)
    assert [(r.adid, r.rk) for r in top.where("day = '2019-11-26' and area = 'north'").orderBy("rk").collect()] \
        == [("2", 1), ("1", 2), ("3", 3)]
    js = {(r.day, r.area): r.top3_json for r in op.day_area_ad_top3_json(top).collect()}
    assert js[("2019-11-26", "north")] == '[{"2":9},{"1":5},{"3":5}]'
    doc = {r.day: r.document for r in op.day_top3_document(op.day_area_ad_top3_json(top)).collect()}
    assert doc["2019-11-26"] == '{"north":"[{\\"2\\":9},{\\"1\\":5},{\\"3\\":5}]","south":"[{\\"2\\":2}]"}'


def test_merge_counts_is_keywise_sum(spark):
    a = spark.createDataFrame([("d", 1), ("e", 2)], "k string, clicks bigint")
    b = spark.createDataFrame([("d", 3), ("f", 4)], "k string, clicks bigint")
    got = sorted(tuple(r) for r in op.merge_counts(a, b, keys=["k"]).collect())
    assert got == [("d", 4), ("e", 2), ("f", 4)]
