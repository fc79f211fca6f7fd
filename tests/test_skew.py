"""Hot keys: one session / one user holding a third of all rows.

The inputs are derived from the test tables by Spark (a third of the events are
moved into one session / to one user); results are compared with the
straightforward formulations (a session-wide window, a per-user scan).
"""

from collections import defaultdict

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse.sources import AdapterTables
from tests.conftest import SF_ORACLE


def _hot_visits(spark):
    v = AdapterTables(spark, SF_ORACLE).visits()
    hot = F.col("event_id") % 3 == 0
    return v.withColumn("session_id", F.when(hot, F.lit("hot_session")).otherwise(F.col("session_id")))


def test_hot_session_jumps_exact(spark):
    v = _hot_visits(spark)
    w = Window.partitionBy("session_id").orderBy("action_time", "event_id")
    naive = (v.select(F.col("page_id").alias("from_page"), F.lead("page_id").over(w).alias("to_page"))
             .where("to_page is not null").groupBy("from_page", "to_page").agg(F.count("*").alias("jumps")))
    for chars in (16, 13):
        got = op.page_transitions(v, chars)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, naive.collect()))


def test_hot_session_is_split_across_slices(spark):
    v = _hot_visits(spark)
    sl = (v.where("session_id = 'hot_session'").select(F.substring("action_time", 1, 16).alias("s"))
          .groupBy("s").count())
    # the hot session (a third of all visits) spreads over many small slices
    assert sl.count() > 1000 and sl.agg(F.max("count")).first()[0] <= 5


def test_hot_user_blacklist_exact(spark):
    c = AdapterTables(spark, SF_ORACLE).clicks()
    c = c.withColumn("userid", F.when(F.col("event_id") % 3 == 0, F.lit("bot")).otherwise(F.col("userid")))
    got = sorted(r.event_id for r in op.blacklist_filtered_clicks(c, 5).select("event_id").collect())
    # plain Python, click by click in (ts, event_id) order
    rows = sorted((r.ts, r.event_id, r.userid, r.adid) for r in c.collect())
    counts, black, want = defaultdict(int), set(), []
    for ts, eid, user, ad in rows:
        if user in black:
            continue
        want.append(eid)
        key = (ts // 86_400_000, user, ad)
        counts[key] += 1
        if counts[key] >= 5:
            black.add(user)
    assert got == sorted(want)
    assert "bot" in black


def test_null_pages_are_visits_but_make_no_jump(spark):
    from tests.helpers import visits
    rows = [dict(session_id="s", page_id=p, action_time=f"2019-11-26 10:0{m}:00") for m, p in ((0, 1), (0, None), (0, 2), (1, None), (2, 3), (2, 4))]
    for chars in (16, 13):
        got = sorted(map(tuple, op.page_transitions(visits(spark, rows), chars).collect()))
        assert got == [(3, 4, 1)], (chars, got)


def test_hot_minute_of_a_hot_session(spark):
    """A third of all visits in one minute of one session: exact, and no fine slice holds more than its ids."""
    v = AdapterTables(spark, SF_ORACLE).visits()
    hot = F.col("event_id") % 3 == 0
    v = (v.withColumn("session_id", F.when(hot, F.lit("hot_session")).otherwise(F.col("session_id")))
         .withColumn("action_time", F.when(hot, F.concat(F.lit("2024-01-05 10:10:"), F.lpad((F.col("event_id") % 60).cast("string"), 2, "0"))).otherwise(F.col("action_time")))
         .withColumn("page_id", F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("page_id"))))
    w = Window.partitionBy("session_id").orderBy("action_time", "event_id")
    naive = (v.select(F.col("page_id").alias("from_page"), F.lead("page_id").over(w).alias("to_page"))
             .where("from_page is not null and to_page is not null").groupBy("from_page", "to_page").agg(F.count("*").alias("jumps")))
    for chars in (16, 13):
        assert sorted(map(tuple, op.page_transitions(v, chars).collect())) == sorted(map(tuple, naive.collect()))
    spread = v.where(hot).groupBy("action_time", F.shiftright("event_id", 16)).count().agg(F.max("count"), F.count("*")).first()
    assert spread[0] <= 200 and spread[1] >= 20
