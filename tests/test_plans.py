"""Plan assertions: the physical plans we rely on for scale."""

import os

import __spark_entry__ as E
from clickpulse import operators as op
from clickpulse.plans import assert_plan, plan_text, write_and_reread
from clickpulse.session import checkpoint_dir
from clickpulse.sources import AdapterTables
from tests.conftest import SF_SMALL


def test_no_python_in_any_batch_plan(spark):
    for key, fn in E.click_log_queries().items():
        text = plan_text(fn(spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert bad not in text, (key, bad)


def test_q4_top_k_is_window_group_limit_and_dims_broadcast(spark):
    df = E.queries()["area_product_top3"](spark, SF_SMALL)
    text = assert_plan(df, contains=["WindowGroupLimit", "BroadcastHashJoin"])
    assert "Partial" in text and "Final" in text
    # the line-item scan reads only the two columns it needs
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in text


def test_top_k_per_group_uses_partial_limit(spark):
    for key in ("category_session_top10", "day_area_ad_top3"):
        text = plan_text(E.queries()[key](spark, SF_SMALL))
        assert "WindowGroupLimit" in text, key
    crossings = op.blacklist_crossings(AdapterTables(spark, SF_SMALL).clicks(), 3)
    assert "WindowGroupLimit" in plan_text(crossings)


BLACKLIST_KEYS = ["blacklist_filtered_clicks", "day_area_city_ad_counts", "day_area_ad_counts", "day_area_ad_top3",
                  "day_area_ad_top3_json", "day_top3_document", "ad_minute_trend", "ad_minute_trend_json",
                  "ad_last_hour_sliding", "ad_sliding_2m_1m", "ad_two_day_trend"]


def test_building_a_query_runs_and_writes_nothing(spark):
    folder = checkpoint_dir(spark)
    before = sorted(os.listdir(folder))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        for key in BLACKLIST_KEYS:
            plan_text(E.queries()[key](spark, SF_SMALL))
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(os.listdir(folder)) == before


def test_written_crossings_give_the_same_clicks(spark):
    clicks = AdapterTables(spark, SF_SMALL).clicks()
    written = write_and_reread(op.blacklist_crossings(clicks, 3), "crossings")
    a, b = op.blacklist_filtered_clicks(clicks, 3), op.blacklist_filtered_clicks(clicks, 3, crossings=written)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_date_range_reaches_the_scan(spark):
    text = plan_text(E.queries()["filtered_visits"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-05" in text and "LessThan(ts,2024-01-26" in text


def test_no_single_partition_from_a_size_check():
    import pathlib
    root = pathlib.Path(E.__file__).parent / "clickpulse"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert ".limit(" not in path.read_text() or path.name in ("categories.py",), path


def test_rank_window_runs_over_distinct_counts(spark):
    text = plan_text(E.queries()["area_product_rank"](spark, SF_SMALL), "simple")
    lines = [ln.strip() for ln in text.splitlines()]
    i = next(k for k, ln in enumerate(lines) if "Window [sum(products" in ln)
    assert any("HashAggregate(keys=[area" in ln and "product_count" in ln for ln in lines[i:i + 6])


def test_sliding_counts_are_dealt_by_block(spark):
    text = plan_text(E.queries()["ad_last_hour_sliding"](spark, SF_SMALL), "simple")
    assert "REPARTITION_BY_COL" in text and ", block#" in text


def test_category_top10_is_take_ordered(spark):
    assert_plan(E.queries()["category_top10"](spark, SF_SMALL), contains=["TakeOrderedAndProject"])


def test_date_filter_pushed_into_stored_visits(spark, scratch):
    path = os.path.join(scratch, "visits")
    AdapterTables(spark, SF_SMALL).visits().write.partitionBy("date").parquet(path)
    v = spark.read.parquet(path)
    users = AdapterTables(spark, SF_SMALL).users()
    df = op.filtered_visits(v, users, {"startDate": "2024-01-03", "endDate": "2024-01-04", "startAge": "20"})
    text = plan_text(df)
    assert "PartitionFilters: [isnotnull(date" in text and "2024-01-03" in text
    assert df.count() == v.where("date between '2024-01-03' and '2024-01-04'").join(
        users.where("age >= 20"), "user_id").count()


def test_page_jumps_window_per_slice_then_reduced_rows(spark):
    text = plan_text(E.queries()["page_transitions"](spark, SF_SMALL), "simple")
    lines = [ln.strip() for ln in text.splitlines()]
    lead = [ln for ln in lines if "Window [lead(" in ln]
    assert lead and all("windowspecdefinition(session_id#" in ln and "fine#" in ln.split("windowspecdefinition(")[1]
                        for ln in lead)
    # the windows of minutes and sessions read aggregates, not visits
    stitched = [k for k, ln in enumerate(lines) if "Window [last(" in ln]
    assert len(stitched) == 2
    for k in stitched:
        below = " ".join(lines[k:k + 6])
        assert "Exchange hashpartitioning(session_id#" in below and "HashAggregate" in below or "SortAggregate" in below


def test_lineitem_clicks_are_the_same_rows_under_any_broadcast_limit(spark):
    from clickpulse.sources.adapters import click_counts_from_lineitem
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        a = sorted(map(tuple, click_counts_from_lineitem(spark, SF_SMALL).collect()))
        spark.conf.set(limit, "-1")
        assert sorted(map(tuple, click_counts_from_lineitem(spark, SF_SMALL).collect())) == a
    finally:
        spark.conf.set(limit, before)


def test_q4_counts_by_city_are_exchanged_once_more_for_totals_and_lists(spark):
    for key in ("area_product_top3", "area_product_top3_visits", "area_product_top3_sql"):
        text = plan_text(E.queries()[key](spark, SF_SMALL), "simple")
        by_city = [ln for ln in text.splitlines() if "Exchange hashpartitioning(area#" in ln and "city_name#" in ln]
        by_pair = [ln for ln in text.splitlines() if "Exchange hashpartitioning(area#" in ln and "city_name#" not in ln and "click_product_id#" in ln]
        assert len(by_city) == 1 and len(by_pair) == 1, (key, text)
        assert "WindowGroupLimit" in text


def test_city_ratio_runs_as_sql(spark):
    from clickpulse.functions import register_city_ratio
    register_city_ratio(spark, "ratio_probe")
    rows = [("n", "a", 21), ("n", "b", 79), ("n", "c", 900), ("s", "z", 1)]
    spark.createDataFrame(rows, "area string, city string, clicks bigint").createOrReplaceTempView("probe_counts")
    got = {r.area: r.r for r in spark.sql("SELECT area, ratio_probe(collect_list(struct(clicks AS c, city))) AS r FROM probe_counts GROUP BY area").collect()}
    assert got == {"n": "c:90.0%,b:7.9%,other:2.1%", "s": "z:100.0%,other:0.0%"}


def test_trend_window_reaches_the_scan(spark):
    for key in ("ad_minute_trend", "ad_minute_trend_json", "ad_two_day_trend"):
        text = plan_text(E.queries()[key](spark, SF_SMALL))
        pushed = [ln for ln in text.splitlines() if ln.startswith("PushedFilters") and "GreaterThanOrEqual(ts,ScalarSubquery" in ln]
        assert pushed, key


def test_filtered_users_filter_a_large_visit_log_before_its_shuffle(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    want = sorted(map(tuple, E.queries()["filtered_visits"](spark, SF_SMALL).collect()))
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = E.queries()["filtered_visits"](spark, SF_SMALL)
        text = plan_text(df, "simple")
        assert "might_contain" in text and "bloom_filter_agg" in text
        assert sorted(map(tuple, df.collect())) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
