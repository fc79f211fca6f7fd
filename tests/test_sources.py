"""Sources: schema assertion, named views for SQL users, helpers."""

import os

import pytest
from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse.functions import parse_day
from clickpulse.schemas import VISITS, SchemaMismatch, assert_schema
from clickpulse.sinks import with_task_id, write_ad_log
from clickpulse.sources import AdapterTables, decode_ad_log, read_ad_lines
from clickpulse.sources.catalog import register_views
from tests import helpers as h
from tests.conftest import SF_SMALL


def test_assert_schema(spark):
    v = AdapterTables(spark, SF_SMALL).visits()
    assert assert_schema(v.select(*reversed(v.columns)), VISITS).columns == v.columns
    with pytest.raises(SchemaMismatch, match="page_id"):
        assert_schema(v.withColumn("page_id", F.col("page_id").cast("string")), VISITS)
    with pytest.raises(SchemaMismatch, match="missing column city_id"):
        assert_schema(v.drop("city_id"), VISITS)


def test_original_sql_runs_on_registered_views(spark):
    t = AdapterTables(spark, SF_SMALL)
    register_views(t)
    register_views(t)                      # twice in one session is fine
    sql = ("select ci.area, ci.city_name, uv.click_product_id from user_visit_action uv "
           "join city_info ci on uv.city_id = ci.city_id where uv.click_product_id > 0")
    got = sorted(map(tuple, spark.sql(sql).collect()))
    assert got == sorted(map(tuple, op.click_geo(t.visits(), t.cities()).collect()))


def test_task_id_and_parse_day(spark):
    df = with_task_id(spark.createDataFrame([("2019-11-26",), ("bad",)], "d string"), "run-1")
    rows = df.select("task_id", parse_day("d").alias("day")).collect()
    assert [(r.task_id, str(r.day)) for r in rows] == [("run-1", "2019-11-26"), ("run-1", "None")]


def test_rounding_and_percent_text(spark):
    from clickpulse.functions import half_up_1dp, percent_text
    df = spark.createDataFrame([(12.25,), (12.24,), (0.05,), (100.0,)], "x double")
    got = [r.t for r in df.select(percent_text(F.lit("a"), half_up_1dp("x")).alias("t")).collect()]
    assert got == ["a:12.3%", "a:12.2%", "a:0.1%", "a:100.0%"]


def test_encoding_keeps_places_and_refuses_delimiters(spark):
    from clickpulse.sources import decode_ad_log, encode_ad_log
    rows = [(1, 1574762400000, "a", None, "u", "1"), (2, 1574762400000, "a,b", "c", "u", "1"),
            (3, 1574762400000, "a", "c\n", "u", "1"), (4, 1574762400000, "a", "c", "u", "1")]
    lines = encode_ad_log(spark.createDataFrame(rows, "id INT, ts BIGINT, area STRING, city STRING, userid STRING, adid STRING"), ("id",))
    got = {r.id: r.value for r in lines.collect()}
    assert got == {1: "1574762400000,a,,u,1", 2: None, 3: None, 4: "1574762400000,a,c,u,1"}
    good, bad = decode_ad_log(lines, ("id",))
    assert [r.id for r in good.collect()] == [4]
    assert {r.id: r.reason for r in bad.collect()} == {1: "blank field", 2: "bad timestamp", 3: "bad timestamp"}


def test_damaged_lines_are_rejected_with_a_reason(spark):
    from clickpulse.sources import decode_ad_log
    lines = {"9223372036854775807,n,c,u,1": "timestamp too late", "99999999999999999,n,c,u,1": "timestamp too late",
             "-9999999999999999,n,c,u,1": "timestamp too early", "7226582400000,n,c,u,1": "timestamp too late",
             "1574762400000,,,,": "blank field", "x,n,c,u,1": "bad timestamp", "": "bad timestamp",
             "1574762400000,n,c,u": "too few fields"}
    good, bad = decode_ad_log(spark.createDataFrame([(x,) for x in [*lines, " 1574762400000, n,c,u,1 ,more"]], "value STRING"))
    assert {r.value: r.reason for r in bad.collect()} == lines
    assert [tuple(r) for r in good.collect()] == [(1574762400000, "n", "c", "u", "1")]


def test_click_log_under_its_own_names(spark, scratch):
    """The offline job reads a click log's four tables, without ``event_id``, and gives what the adapted tables give."""
    import os

    import pytest

    from clickpulse.jobs import parquet_writer, run_offline
    from clickpulse.schemas import SchemaMismatch
    from clickpulse.sources import AdapterTables
    from clickpulse.sources.tables import CLICK_LOG, ClickLogTables
    from tests.conftest import SF_SMALL
    t = AdapterTables(spark, SF_SMALL)
    log = os.path.join(scratch, "log")
    for name, df in (("visits", t.visits().drop("event_id")), ("users", t.users()), ("products", t.products()), ("cities", t.cities())):
        df.write.parquet(os.path.join(log, f"{CLICK_LOG[name]}.parquet"))
    params = {"startDate": "2024-01-02", "endDate": "2024-01-20"}
    a, b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    names = run_offline(spark, SF_SMALL, params, "t", parquet_writer(a))
    run_offline(spark, log, params, "t", parquet_writer(b), click_log=True)
    tied = t.visits().groupBy("session_id", "action_time").count().where("count > 1").count()
    for name in names:
        x, y = (sorted(map(str, spark.read.parquet(os.path.join(d, name)).collect())) for d in (a, b))
        assert x == y or (name == "jump_page_ratio" and tied), name
    t.users().drop("age").write.parquet(os.path.join(scratch, "bad", "user_info.parquet"))
    with pytest.raises(SchemaMismatch):
        ClickLogTables(spark, os.path.join(scratch, "bad")).users()


HOSTILE = ["a,b", '"', '""', 'say "no", twice', "\n", "\r\n", "\\", "\\n", "\\\\n", "x\\", " lead", "trail ", ",", '",', "\u00e9\u4e2d\U0001f600", "\t", "a\\\r\n\\\\", "''", "%s"]


def test_quoted_lines_round_trip_through_text_files(spark, scratch):
    import itertools
    rows = [(1574762400000 + i, a + "1", b + "2", "u" + a, b + "3") for i, (a, b) in enumerate(itertools.product(HOSTILE, HOSTILE))]
    clicks = h.clicks(spark, rows, with_id=False)
    path = os.path.join(scratch, "quoted")
    write_ad_log(clicks, path=path, quoted=True)
    lines = read_ad_lines(spark, path)
    assert lines.count() == len(rows)                    # a record is a line
    good, bad = decode_ad_log(lines, quoted=True)
    assert bad.count() == 0 and sorted(map(tuple, good.collect())) == sorted(rows)


def test_quoted_reader_rejects_what_is_damaged(spark):
    lines = {'"1574762400000","n","c","u","1"': None, '1574762400000,n,c,u,1': None, '"1574762400000","n","c","u"': "too few fields",
             '"x","n","c","u","1"': "bad timestamp", '"1574762400000","n","c"," ","1"': "blank field", '"1574762400000","n","c","u","1","more"': None,
             "": "bad timestamp", '"1","n","c","u","1"': "timestamp too early", '"9999999999999999","n","c","u","1"': "timestamp too late", '"1574762400000","n","c","u","1': None,
             '"1574762400000,n,c,u,1': "bad timestamp"}
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    _, bad = decode_ad_log(df, quoted=True)
    got = {r.value: r.reason for r in bad.collect()}
    want = {k: v for k, v in lines.items() if v}
    got.pop('"1574762400000","n","c","u","1', None)      # a last quote that is missing: either way
    assert got == want


def test_plain_writer_keeps_rows_apart_that_it_cannot_write(spark, scratch):
    rows = [(1574762400000, "n", "c", "u", "1"), (1574762400001, "n", "a,b", "u", "1"), (1574762400002, "n", "c\n", "u", "1")]
    clicks = h.clicks(spark, rows)
    path, apart = os.path.join(scratch, "plain"), os.path.join(scratch, "apart")
    write_ad_log(clicks, path=path, rejects=apart)
    assert [r.value for r in read_ad_lines(spark, path).collect()] == ["1574762400000,n,c,u,1"]
    assert sorted(r.ts for r in spark.read.parquet(apart).collect()) == [1574762400001, 1574762400002]
    with pytest.raises(Exception, match="delimiter"):
        write_ad_log(clicks, path=os.path.join(scratch, "error"))

