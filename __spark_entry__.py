"""

``entry(spark)`` runs the flagship query (Q4, area product top-3 over the
line-item click log) on sf0.001. ``queries()`` maps every implemented
operator/analysis to ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives
the independent DuckDB SQL for the same result over the raw test tables.
Every query runs over the whole tables; parameters (dates, thresholds, the
page flow) are the analyses' own inputs, not row caps.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickpulse import operators as op  # noqa: E402
from clickpulse.sources import AdapterTables, decode_ad_log, encode_ad_log  # noqa: E402
from clickpulse.sources.catalog import area_product_top3_sql  # noqa: E402

# The training-data operators and their pipeline are optional: where they, or a package they need, can't be imported, the rest still works.
try:
    import corpus_pipeline
    from clickpulse.llm import registry as llm_registry
except ImportError:
    corpus_pipeline = llm_registry = None

FLAGSHIP_SF = "/root/testdata/sf0.001"

# Parameters of the registered queries (the analyses' inputs).
BLACKLIST_THRESHOLD = 3          # the reference's 100 is never reached by the test data
FLOW = "1,2,3,4,5,6,7"
FILTER_PARAMS = {"startDate": "2024-01-05", "endDate": "2024-01-25", "startAge": "20",
                 "endAge": "50", "professional": "BUILDING,MACHINERY", "gender": "F"}
FILTER_PARAMS_CITY = {"city": "NATION_1,NATION_7,NATION_12,NATION_20", "keywords": "kw_1,kw_4"}
MERGE_SPLIT_DAY = "2024-01-16"
# The original's parameter set, moved to the test data's dates: Q0 feeds Q1-Q3.
REFERENCE_PARAMS = {"startDate": "2024-01-01", "endDate": "2024-01-28", "startAge": "20", "endAge": "50",
                    "professionals": "", "city": "", "gender": "", "keywords": "", "categoryIds": ""}


_TABLES: dict = {}


def _t(spark: SparkSession, sf_dir: str) -> AdapterTables:
    """Adapted input tables, defined once per session and directory (logical
    plans only -- nothing is cached, every query reads the files)."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - sessions without a SparkContext handle
        app = None
    key = (app, id(spark), sf_dir)
    if key not in _TABLES:
        _TABLES[key] = AdapterTables(spark, sf_dir)
    return _TABLES[key]


def _flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return op.area_product_top3(t.lineitem_clicks(), t.cities(), t.products(), weight="clicks")


def entry(spark: SparkSession) -> DataFrame:
    return _flagship(spark, FLAGSHIP_SF)


def _q0(spark, sf_dir):
    t = _t(spark, sf_dir)
    return op.filtered_visits(t.visits(REFERENCE_PARAMS), t.users(), REFERENCE_PARAMS)


def _survivors(spark, sf_dir):
    return op.blacklist_filtered_clicks(_t(spark, sf_dir).clicks(), BLACKLIST_THRESHOLD)


def _q6(spark, sf_dir):
    return op.day_area_city_ad_counts(_survivors(spark, sf_dir).drop("event_id"))


def _q7_counts(spark, sf_dir):
    return op.day_area_ad_counts(_q6(spark, sf_dir))


def _q7_top3(spark, sf_dir):
    return op.day_area_ad_top3(_q7_counts(spark, sf_dir))


def _q7_json(spark, sf_dir):
    return op.day_area_ad_top3_json(_q7_top3(spark, sf_dir))


def _decode(spark, sf_dir):
    lines = encode_ad_log(_t(spark, sf_dir).clicks(), keep=("event_id",))
    good, _rejects = decode_ad_log(lines, keep=("event_id",))
    return good


def _damaged_lines(spark, sf_dir):
    """The encoded clicks, every line damaged in one of six ways or left whole, by its id."""
    lines = encode_ad_log(_t(spark, sf_dir).clicks(), keep=("event_id",))
    f = lambda i: F.get(F.split("value", ","), i)
    how = F.col("event_id") % 7
    return lines.select("event_id", F.when(how == 0, F.concat_ws(",", f(0), f(1), f(2), f(3)))
                        .when(how == 1, F.concat(F.lit("x"), F.col("value")))
                        .when(how == 2, F.concat_ws(",", F.lit("9223372036854775807"), f(1), f(2), f(3), f(4)))
                        .when(how == 3, F.concat_ws(",", f(0), f(1), f(2), F.lit(" "), f(4)))
                        .when(how == 4, F.concat_ws(",", F.lit("-1"), f(1), f(2), f(3), f(4)))
                        .when(how == 5, F.concat(F.col("value"), F.lit(",more")))
                        .otherwise(F.col("value")).alias("value"))


def _decode_damaged(spark, sf_dir):
    return decode_ad_log(_damaged_lines(spark, sf_dir), keep=("event_id",))


def _hostile_clicks(spark, sf_dir):
    """The clicks with texts that need quoting, by their id."""
    how = F.col("event_id") % 6
    city = (F.when(how == 0, F.concat(F.col("city"), F.lit(", \"old\" town"))).when(how == 1, F.concat(F.lit("\n"), F.col("city"), F.lit("\r\n")))
            .when(how == 2, F.concat(F.lit(" \\n"), F.col("city"), F.lit("\\ "))).when(how == 3, F.concat(F.lit("\""), F.col("city"), F.lit("\"\""))).otherwise(F.col("city")))
    return _t(spark, sf_dir).clicks().withColumn("city", city).withColumn("adid", F.when(how == 4, F.lit(" ")).otherwise(F.col("adid")))


def _quoted(spark, sf_dir):
    """Quoted lines, some cut after three fields or with one more."""
    lines = encode_ad_log(_hostile_clicks(spark, sf_dir), keep=("event_id",), quoted=True)
    how = F.col("event_id") % 11
    return lines.withColumn("value", F.when(how == 9, F.regexp_extract("value", '^("([^"]|"")*",){2}"([^"]|"")*"', 0)).when(how == 10, F.concat("value", F.lit(',"more, ""and"" more"'))).otherwise(F.col("value")))


def _decode_quoted(spark, sf_dir):
    return decode_ad_log(_quoted(spark, sf_dir), keep=("event_id",), quoted=True)


def _damaged_lists(spark, sf_dir):
    """The visits with a piece of text, an empty entry or a number too large in some id lists, by their id."""
    how = F.col("event_id") % 5
    more = lambda c: F.when(how == 0, F.concat(c, F.lit(",x1"))).when(how == 1, F.concat(F.lit(","), c)).when(how == 2, F.concat(c, F.lit(",99999999999999999999"))).otherwise(F.col(c))
    return _t(spark, sf_dir).visits().withColumns({c: more(c) for c in ("order_category_ids", "pay_category_ids")})


def _merge(spark, sf_dir):
    clicks = op.with_time(_t(spark, sf_dir).clicks())
    keys = ["day", "area", "city", "adid"]
    first = op.day_area_city_ad_counts(clicks.where(F.col("day") < MERGE_SPLIT_DAY).drop("event_time", "day"))
    second = op.day_area_city_ad_counts(clicks.where(F.col("day") >= MERGE_SPLIT_DAY).drop("event_time", "day"))
    return op.merge_counts(first, second, keys=keys, value="clicks")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = click_log_queries()
    if llm_registry:
        found |= llm_registry.queries()
        found["pipeline"] = corpus_pipeline.run
    return found


def click_log_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # Q0
        "scan_visits": lambda s, d: _t(s, d).visits(),
        "filtered_visits": lambda s, d: op.filtered_visits(
            _t(s, d).visits(FILTER_PARAMS), _t(s, d).users(), FILTER_PARAMS),
        "filtered_visits_city": lambda s, d: op.filtered_visits(
            _t(s, d).visits(), _t(s, d).users(), FILTER_PARAMS_CITY, cities=_t(s, d).cities()),
        # Q1 / Q2
        "category_action_counts": lambda s, d: op.category_action_counts(_t(s, d).visits()),
        "unreadable_category_ids": lambda s, d: op.unreadable_category_ids(_damaged_lists(s, d)),
        "category_action_counts_damaged": lambda s, d: op.category_action_counts(_damaged_lists(s, d)),
        "category_top10": lambda s, d: op.category_top10(_t(s, d).visits()),
        "category_session_counts": lambda s, d: op.category_session_counts(_t(s, d).visits()),
        "category_session_top10": lambda s, d: op.category_session_top10(_t(s, d).visits()),
        "category_top10_filtered": lambda s, d: op.category_top10(_q0(s, d)),
        "category_session_top10_filtered": lambda s, d: op.category_session_top10(_q0(s, d)),
        # Q3
        "page_views": lambda s, d: op.page_views(_t(s, d).visits()),
        "page_transitions": lambda s, d: op.page_transitions(_t(s, d).visits()),
        "page_jump_ratio": lambda s, d: op.page_jump_ratio(_t(s, d).visits(), FLOW),
        "page_jump_ratio_filtered": lambda s, d: op.page_jump_ratio(_q0(s, d), FLOW),
        # Q4
        "click_geo": lambda s, d: op.click_geo(_t(s, d).visits(), _t(s, d).cities()),
        "area_product_counts": lambda s, d: op.area_product_counts(
            _t(s, d).lineitem_clicks(), _t(s, d).cities(), weight="clicks"),
        "area_product_rank": lambda s, d: op.area_product_rank(
            _t(s, d).lineitem_clicks(), _t(s, d).cities(), weight="clicks"),
        "city_click_ratio": lambda s, d: op.city_click_ratio(
            _t(s, d).lineitem_clicks(), _t(s, d).cities(), weight="clicks"),
        "area_product_top3": _flagship,
        "area_product_top3_visits": lambda s, d: op.area_product_top3(
            _t(s, d).visits(), _t(s, d).cities(), _t(s, d).products()),
        "area_product_top3_sql": lambda s, d: area_product_top3_sql(_t(s, d)),
        # Q5 - Q8 (batch twins of the stream)
        "encode_ad_log": lambda s, d: encode_ad_log(_t(s, d).clicks(), keep=("event_id",)),
        "decode_ad_log": _decode,
        "decode_ad_log_damaged": lambda s, d: _decode_damaged(s, d)[0],
        "decode_ad_log_rejects": lambda s, d: _decode_damaged(s, d)[1],
        "encode_ad_log_quoted": lambda s, d: encode_ad_log(_hostile_clicks(s, d), keep=("event_id",), quoted=True),
        "decode_ad_log_quoted": lambda s, d: _decode_quoted(s, d)[0],
        "decode_ad_log_quoted_rejects": lambda s, d: _decode_quoted(s, d)[1],
        "user_day_ad_counts": lambda s, d: op.user_day_ad_counts(_t(s, d).clicks()),
        "blacklist_users": lambda s, d: op.blacklist_users(_t(s, d).clicks(), BLACKLIST_THRESHOLD),
        "blacklist_filtered_clicks": _survivors,
        "day_area_city_ad_counts": _q6,
        "day_area_ad_counts": _q7_counts,
        "day_area_ad_top3": _q7_top3,
        "day_area_ad_top3_json": _q7_json,
        "day_top3_document": lambda s, d: op.day_top3_document(_q7_json(s, d)),
        "ad_minute_trend": lambda s, d: op.ad_recent_trend(_t(s, d).clicks, 60, BLACKLIST_THRESHOLD),
        "ad_minute_trend_json": lambda s, d: op.ad_minute_trend_json(op.ad_recent_trend(_t(s, d).clicks, 60, BLACKLIST_THRESHOLD)),
        "ad_two_day_trend": lambda s, d: op.ad_recent_trend(_t(s, d).clicks, 2 * 24 * 60, BLACKLIST_THRESHOLD),
        "ad_last_hour_sliding": lambda s, d: op.ad_last_hour_sliding(_survivors(s, d)),
        "ad_sliding_2m_1m": lambda s, d: op.ad_last_hour_sliding(_survivors(s, d), 2, 1),
        "merge_counts": _merge,
    }


# ---------------------------------------------------------------------------
# DuckDB oracle. The adapters are repeated here in SQL so that the oracle
# shares no code with the Spark side.

_CTE = {
    "cities": """cities AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS city_id, n.n_name AS city_name, r.r_name AS area
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    "products": """products AS (
  SELECT p_partkey + 1 AS product_id, p_name AS product_name, p_brand AS extend_info FROM part)""",
    "users": """users AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(10 + c_custkey % 50 AS INTEGER) AS age, c_mktsegment AS professional,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer)""",
    "ev": """ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(CAST(props->>'$.k' AS INTEGER) AS BIGINT) AS k FROM events)""",
    "visits": """visits AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
         CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
         k % 7 + 1 AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw_' || CAST(k % 6 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k + 1 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k + 7) % 20 + 1 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k + 1 AS VARCHAR) || ',' || CAST((k + 7) % 100 + 1 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k + 3) % 20 + 1 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k + 1 AS VARCHAR) || ',' || CAST((k + 3) % 100 + 1 AS VARCHAR) END AS pay_product_ids,
         event_id % 25 AS city_id, event_id
  FROM ev)""",
    "clicks": """clicks AS (
  SELECT e.event_id, epoch_us(e.ts) // 1000 AS ts, c.area, c.city_name AS city,
         CAST(e.user_id AS VARCHAR) AS userid, CAST(e.k % 6 + 1 AS VARCHAR) AS adid
  FROM ev e JOIN cities c ON e.user_id % 25 = c.city_id)""",
    "clicks_t": """clicks_t AS (
  SELECT *, make_timestamp(ts * 1000) AS event_time, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS day
  FROM clicks)""",
    "survivors": f"""kth AS (
  SELECT userid, ts, event_id FROM (
    SELECT userid, ts, event_id,
           row_number() OVER (PARTITION BY day, userid, adid ORDER BY ts, event_id) AS rn
    FROM clicks_t) WHERE rn = {BLACKLIST_THRESHOLD}),
crossing AS (
  SELECT userid, ts AS c_ts, event_id AS c_id FROM (
    SELECT userid, ts, event_id, row_number() OVER (PARTITION BY userid ORDER BY ts, event_id) AS r
    FROM kth) WHERE r = 1),
survivors AS (
  SELECT c.event_id, c.ts, c.area, c.city, c.userid, c.adid
  FROM clicks c LEFT JOIN crossing x ON c.userid = x.userid
  WHERE x.c_ts IS NULL OR c.ts < x.c_ts OR (c.ts = x.c_ts AND c.event_id <= x.c_id)),
survivors_t AS (
  SELECT *, make_timestamp(ts * 1000) AS event_time, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS day
  FROM survivors)""",
    "q6": """q6 AS (
  SELECT day, area, city, adid, count(*) AS clicks FROM survivors_t GROUP BY day, area, city, adid)""",
    "q7": """q7 AS (
  SELECT day, area, adid, CAST(sum(clicks) AS BIGINT) AS clicks FROM q6 GROUP BY day, area, adid)""",
    "top3": """top3 AS (
  SELECT * FROM (
    SELECT day, area, adid, clicks,
           row_number() OVER (PARTITION BY day, area ORDER BY clicks DESC, adid) AS rk FROM q7)
  WHERE rk <= 3)""",
    "top3_json": """top3_json AS (
  SELECT day, area,
         '[' || string_agg('{"' || adid || '":' || CAST(clicks AS VARCHAR) || '}', ',' ORDER BY rk) || ']' AS top3_json
  FROM top3 GROUP BY day, area)""",
    "damaged": """damaged AS (
  SELECT *, CASE event_id % 7
    WHEN 0 THEN CAST(ts AS VARCHAR) || ',' || area || ',' || city || ',' || userid
    WHEN 1 THEN 'x' || CAST(ts AS VARCHAR) || ',' || area || ',' || city || ',' || userid || ',' || adid
    WHEN 2 THEN '9223372036854775807,' || area || ',' || city || ',' || userid || ',' || adid
    WHEN 3 THEN CAST(ts AS VARCHAR) || ',' || area || ',' || city || ', ,' || adid
    WHEN 4 THEN '-1,' || area || ',' || city || ',' || userid || ',' || adid
  END AS value FROM clicks)""",
    "hostile": """hostile AS (
  SELECT event_id, ts, area, CASE event_id % 6 WHEN 0 THEN city || ', "old" town' WHEN 1 THEN chr(10) || city || chr(13) || chr(10)
      WHEN 2 THEN ' \\n' || city || '\\ ' WHEN 3 THEN '"' || city || '""' ELSE city END AS city, userid,
    CASE WHEN event_id % 6 = 4 THEN ' ' ELSE adid END AS adid FROM clicks),
quoted AS (
  SELECT *, '"' || CAST(ts AS VARCHAR) || '","' || area || '","'
      || replace(replace(replace(replace(city, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), '"', '""') || '"' AS head, '"' || userid || '","' || adid || '"' AS tail FROM hostile)""",
    "minutes": """mc AS (
  SELECT adid, date_trunc('minute', event_time) AS minute_ts, count(*) AS clicks
  FROM survivors_t GROUP BY adid, date_trunc('minute', event_time)),
trend AS (
  SELECT adid, strftime(minute_ts, '%Y-%m-%d %H:%M') AS minute, clicks FROM mc
  WHERE minute_ts > (SELECT max(minute_ts) FROM mc) - INTERVAL 60 MINUTE
    AND minute_ts <= (SELECT max(minute_ts) FROM mc))""",
    "li_clicks": """li_clicks AS (
  SELECT CAST(s.s_nationkey AS BIGINT) AS city_id, l.l_partkey + 1 AS click_product_id
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey)""",
}


def _with(*names: str) -> str:
    return "WITH " + ",\n".join(_CTE[n] for n in names) + "\n"


def _geo_counts(src: str) -> str:
    return f"""geo AS (
  SELECT c.area, c.city_name, v.click_product_id, count(*) AS clicks
  FROM {src} v JOIN cities c ON v.city_id = c.city_id
  WHERE v.click_product_id > 0
  GROUP BY c.area, c.city_name, v.click_product_id),
pc AS (
  SELECT area, click_product_id, CAST(sum(clicks) AS BIGINT) AS product_count FROM geo GROUP BY area, click_product_id)"""


def _share(groups: str) -> str:
    """City share text for the (area, click_product_id, product_count) rows of ``groups``."""
    return f"""ranked_cities AS (
  SELECT g.area, g.click_product_id, g.city_name, g.clicks, p.product_count,
         row_number() OVER (PARTITION BY g.area, g.click_product_id ORDER BY g.clicks DESC, g.city_name) AS pos
  FROM geo g JOIN {groups} p ON g.area = p.area AND g.click_product_id = p.click_product_id),
shown AS (
  SELECT area, click_product_id, city_name, pos, product_count, other_clicks,
         floor(clicks * CAST(1000.0 AS DOUBLE) / product_count + CAST(0.5 AS DOUBLE)) / CAST(10.0 AS DOUBLE) AS pct
  FROM ranked_cities LEFT JOIN (
    SELECT area, click_product_id, sum(clicks) AS other_clicks FROM ranked_cities WHERE pos > 2 GROUP BY ALL) rest USING (area, click_product_id)
  WHERE pos <= 2),
share AS (
  SELECT area, click_product_id,
         string_agg(city_name || ':' || CAST(pct AS VARCHAR) || '%', ',' ORDER BY pos)
         || ',other:'
         || CAST(floor(coalesce(any_value(other_clicks), 0) * CAST(1000.0 AS DOUBLE) / any_value(product_count) + CAST(0.5 AS DOUBLE)) / CAST(10.0 AS DOUBLE) AS VARCHAR)
         || '%' AS city_click_ratio
  FROM shown GROUP BY area, click_product_id)"""


def _top3_sql(src_ctes: tuple[str, ...], src: str) -> str:
    return _with(*src_ctes) + "," + _geo_counts(src) + """,
top AS (
  SELECT * FROM (SELECT area, click_product_id, product_count,
                        rank() OVER (PARTITION BY area ORDER BY product_count DESC) AS rk FROM pc)
  WHERE rk <= 3),
""" + _share("top") + """
SELECT t.area, t.click_product_id AS product_id, p.product_name, t.product_count, s.city_click_ratio,
       CAST(t.rk AS BIGINT) AS rk
FROM top t JOIN share s ON t.area = s.area AND t.click_product_id = s.click_product_id
JOIN products p ON p.product_id = t.click_product_id"""


def _sliding(window: int, slide: int) -> str:
    n = -(-window // slide)
    return _with("cities", "ev", "clicks", "clicks_t", "survivors") + f""",
mc AS (
  SELECT adid, date_diff('minute', TIMESTAMP '1970-01-01 00:00:00', date_trunc('minute', event_time)) AS em,
         count(*) AS clicks
  FROM survivors_t GROUP BY adid, em),
fan AS (
  SELECT adid, clicks, em - em % {slide} - j * {slide} AS start, em
  FROM mc, (SELECT unnest(range(0, {n})) AS j) js),
agg AS (
  SELECT start, adid, CAST(sum(clicks) AS BIGINT) AS clicks FROM fan WHERE start > em - {window} GROUP BY start, adid)
SELECT strftime(TIMESTAMP '1970-01-01 00:00:00' + to_minutes(start), '%Y-%m-%d %H:%M') AS window_start,
       strftime(TIMESTAMP '1970-01-01 00:00:00' + to_minutes(start + {window}), '%Y-%m-%d %H:%M') AS window_end,
       adid, clicks
FROM agg"""


def _filter_sql() -> str:
    p = FILTER_PARAMS
    profs = ", ".join(f"'{x}'" for x in p["professional"].split(","))
    return _with("ev", "visits", "users") + f"""
SELECT v.* FROM visits v JOIN users u ON v.user_id = u.user_id
WHERE v.date >= '{p['startDate']}' AND v.date <= '{p['endDate']}'
  AND u.age >= {p['startAge']} AND u.age <= {p['endAge']}
  AND u.professional IN ({profs}) AND u.gender = '{p['gender']}'"""


def _filter_city_sql() -> str:
    p = FILTER_PARAMS_CITY
    cities = ", ".join(f"'{x}'" for x in p["city"].split(","))
    kws = ", ".join(f"'{x}'" for x in p["keywords"].split(","))
    return _with("ev", "visits", "users", "cities") + f"""
SELECT v.* FROM visits v JOIN users u ON v.user_id = u.user_id JOIN cities c ON v.city_id = c.city_id
WHERE c.city_name IN ({cities}) AND v.search_keyword IN ({kws})"""


_ACTIONS = """acts AS (
  SELECT 'click' AS action, click_category_id AS category_id FROM visits WHERE click_category_id <> -1
  UNION ALL
  SELECT 'order', CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT) FROM visits
  WHERE click_category_id = -1 AND order_category_ids IS NOT NULL
  UNION ALL
  SELECT 'pay', CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) FROM visits
  WHERE click_category_id = -1 AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL),
counts AS (
  SELECT category_id, count(*) FILTER (WHERE action = 'click') AS click_count,
         count(*) FILTER (WHERE action = 'order') AS order_count,
         count(*) FILTER (WHERE action = 'pay') AS pay_count
  FROM acts GROUP BY category_id)"""

_JUMPS = """jumps AS (
  SELECT page_id AS from_page, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS to_page
  FROM visits)"""

_TOP10 = """
SELECT * FROM counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10"""

_SESSION_TOP10 = """,
top AS (SELECT category_id FROM counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10),
cs AS (SELECT click_category_id AS category_id, session_id, count(*) AS click_count
       FROM visits WHERE click_category_id IN (SELECT category_id FROM top) GROUP BY 1, 2)
SELECT category_id, session_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rk FROM cs)
WHERE rk <= 10"""


def _on(sql: str, src: str) -> str:
    """The same SQL text reading ``src`` instead of ``visits``."""
    return sql.replace("FROM visits", f"FROM {src}")


def _q0_cte() -> str:
    p = REFERENCE_PARAMS
    return f"""q0 AS (
  SELECT v.* FROM visits v JOIN users u ON v.user_id = u.user_id
  WHERE v.date >= '{p['startDate']}' AND v.date <= '{p['endDate']}'
    AND u.age >= {p['startAge']} AND u.age <= {p['endAge']})"""


def _jump_ratio(src: str) -> str:
    flow = [int(x) for x in FLOW.split(",")]
    flow_rows = ", ".join(f"({a}, {b})" for a, b in zip(flow[:-1], flow[1:]))
    return _on(_JUMPS, src) + f""",
flow(from_page, to_page) AS (VALUES {flow_rows}),
j AS (SELECT from_page, to_page, count(*) AS jumps FROM jumps WHERE to_page IS NOT NULL GROUP BY 1, 2),
pv AS (SELECT page_id, count(*) AS page_views FROM {src} GROUP BY page_id)
SELECT CAST(f.from_page AS VARCHAR) || '-' || CAST(f.to_page AS VARCHAR) AS jump,
       CAST(f.from_page AS BIGINT) AS from_page, CAST(f.to_page AS BIGINT) AS to_page,
       coalesce(j.jumps, 0) AS jumps, coalesce(pv.page_views, 0) AS page_views,
       CASE WHEN coalesce(pv.page_views, 0) > 0
            THEN CAST(coalesce(j.jumps, 0) AS DOUBLE) / CAST(pv.page_views AS DOUBLE) END AS ratio
FROM flow f LEFT JOIN j ON f.from_page = j.from_page AND f.to_page = j.to_page
LEFT JOIN pv ON pv.page_id = f.from_page"""


def oracle_sql() -> dict[str, str]:
    found = click_log_oracle_sql()
    if llm_registry:
        found |= llm_registry.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def click_log_oracle_sql() -> dict[str, str]:
    q0 = _with("ev", "visits", "users") + "," + _q0_cte() + ","
    return {
        "scan_visits": _with("ev", "visits") + "SELECT * FROM visits",
        "filtered_visits": _filter_sql(),
        "filtered_visits_city": _filter_city_sql(),
        "category_action_counts": _with("ev", "visits") + "," + _ACTIONS + "\nSELECT * FROM counts",
        "unreadable_category_ids": _with("ev", "visits") + """
SELECT action, CASE event_id % 5 WHEN 0 THEN 'x1' WHEN 1 THEN '' ELSE '99999999999999999999' END AS id_text, count(*) AS mentions
FROM (SELECT event_id, CASE WHEN order_category_ids IS NOT NULL THEN 'order' ELSE 'pay' END AS action FROM visits
      WHERE click_category_id = -1 AND (order_category_ids IS NOT NULL OR pay_category_ids IS NOT NULL))
WHERE event_id % 5 < 3 GROUP BY 1, 2""",
        "category_action_counts_damaged": _with("ev", "visits") + "," + _ACTIONS + "\nSELECT * FROM counts",
        "category_top10": _with("ev", "visits") + "," + _ACTIONS + _TOP10,
        "category_session_counts": _with("ev", "visits") + """
SELECT click_category_id AS category_id, session_id, count(*) AS click_count
FROM visits WHERE click_category_id <> -1 GROUP BY 1, 2""",
        "category_session_top10": _with("ev", "visits") + "," + _ACTIONS + _SESSION_TOP10,
        "category_top10_filtered": q0 + _on(_ACTIONS, "q0") + _TOP10,
        "category_session_top10_filtered": q0 + _on(_ACTIONS, "q0") + _on(_SESSION_TOP10, "q0"),
        "page_views": _with("ev", "visits") + "SELECT page_id, count(*) AS page_views FROM visits GROUP BY page_id",
        "page_transitions": _with("ev", "visits") + "," + _JUMPS + """
SELECT from_page, to_page, count(*) AS jumps FROM jumps WHERE to_page IS NOT NULL GROUP BY 1, 2""",
        "page_jump_ratio": _with("ev", "visits") + "," + _jump_ratio("visits"),
        "page_jump_ratio_filtered": q0 + _jump_ratio("q0"),
        "click_geo": _with("ev", "visits", "cities") + """
SELECT c.area, c.city_name, v.click_product_id
FROM visits v JOIN cities c ON v.city_id = c.city_id WHERE v.click_product_id > 0""",
        "area_product_counts": _with("cities", "li_clicks") + "," + _geo_counts("li_clicks")
        + "\nSELECT * FROM pc",
        "area_product_rank": _with("cities", "li_clicks") + "," + _geo_counts("li_clicks") + """
SELECT area, click_product_id, product_count,
       CAST(rank() OVER (PARTITION BY area ORDER BY product_count DESC) AS BIGINT) AS rk FROM pc""",
        "city_click_ratio": _with("cities", "li_clicks") + "," + _geo_counts("li_clicks") + ",\n"
        + _share("pc") + """
SELECT p.area, p.click_product_id, p.product_count, s.city_click_ratio
FROM pc p JOIN share s ON p.area = s.area AND p.click_product_id = s.click_product_id""",
        "area_product_top3": _top3_sql(("cities", "products", "li_clicks"), "li_clicks"),
        "area_product_top3_visits": _top3_sql(("cities", "products", "ev", "visits"), "visits"),
        "area_product_top3_sql": _top3_sql(("cities", "products", "ev", "visits"), "visits"),
        "encode_ad_log": _with("cities", "ev", "clicks") + """
SELECT event_id, CAST(ts AS VARCHAR) || ',' || area || ',' || city || ',' || userid || ',' || adid AS value
FROM clicks""",
        "decode_ad_log": _with("cities", "ev", "clicks") + "SELECT * FROM clicks",
        "decode_ad_log_damaged": _with("cities", "ev", "clicks")
        + "SELECT * FROM clicks WHERE event_id % 7 IN (5, 6)",
        "decode_ad_log_rejects": _with("cities", "ev", "clicks", "damaged") + """
SELECT event_id, value, CASE event_id % 7 WHEN 0 THEN 'too few fields' WHEN 1 THEN 'bad timestamp'
  WHEN 2 THEN 'timestamp too late' WHEN 3 THEN 'blank field' ELSE 'timestamp too early' END AS reason
FROM damaged WHERE event_id % 7 < 5""",
        "encode_ad_log_quoted": _with("cities", "ev", "clicks", "hostile") + "SELECT event_id, head || ',' || tail AS value FROM quoted",
        "decode_ad_log_quoted": _with("cities", "ev", "clicks", "hostile")
        + "SELECT event_id, ts, area, city, userid, adid FROM hostile WHERE event_id % 11 <> 9 AND event_id % 6 <> 4",
        "decode_ad_log_quoted_rejects": _with("cities", "ev", "clicks", "hostile") + """
SELECT event_id, CASE event_id % 11 WHEN 9 THEN head WHEN 10 THEN head || ',' || tail || ',"more, ""and"" more"' ELSE head || ',' || tail END AS value,
       CASE WHEN event_id % 11 = 9 THEN 'too few fields' ELSE 'blank field' END AS reason
FROM quoted WHERE event_id % 11 = 9 OR event_id % 6 = 4""",
        "user_day_ad_counts": _with("cities", "ev", "clicks", "clicks_t") + """
SELECT day, userid, adid, count(*) AS clicks FROM clicks_t GROUP BY day, userid, adid""",
        "blacklist_users": _with("cities", "ev", "clicks", "clicks_t") + f"""
SELECT DISTINCT userid FROM (
  SELECT day, userid, adid, count(*) AS clicks FROM clicks_t GROUP BY day, userid, adid)
WHERE clicks >= {BLACKLIST_THRESHOLD}""",
        "blacklist_filtered_clicks": _with("cities", "ev", "clicks", "clicks_t", "survivors")
        + "SELECT event_id, ts, area, city, userid, adid FROM survivors",
        "day_area_city_ad_counts": _with("cities", "ev", "clicks", "clicks_t", "survivors", "q6")
        + "SELECT * FROM q6",
        "day_area_ad_counts": _with("cities", "ev", "clicks", "clicks_t", "survivors", "q6", "q7")
        + "SELECT * FROM q7",
        "day_area_ad_top3": _with("cities", "ev", "clicks", "clicks_t", "survivors", "q6", "q7", "top3")
        + "SELECT day, area, adid, clicks, CAST(rk AS BIGINT) AS rk FROM top3",
        "day_area_ad_top3_json": _with("cities", "ev", "clicks", "clicks_t", "survivors", "q6", "q7", "top3",
                                       "top3_json") + "SELECT * FROM top3_json",
        "day_top3_document": _with("cities", "ev", "clicks", "clicks_t", "survivors", "q6", "q7", "top3",
                                   "top3_json") + """
SELECT day, '{' || string_agg(to_json(area)::VARCHAR || ':' || to_json(top3_json)::VARCHAR, ',' ORDER BY area) || '}' AS document
FROM top3_json GROUP BY day""",
        "ad_minute_trend": _with("cities", "ev", "clicks", "clicks_t", "survivors", "minutes")
        + "SELECT * FROM trend",
        "ad_two_day_trend": (_with("cities", "ev", "clicks", "clicks_t", "survivors", "minutes")
                             + "SELECT * FROM trend").replace("INTERVAL 60 MINUTE", "INTERVAL 2880 MINUTE"),
        "ad_minute_trend_json": _with("cities", "ev", "clicks", "clicks_t", "survivors", "minutes") + """
SELECT adid, '[' || string_agg('{"' || minute || '":' || CAST(clicks AS VARCHAR) || '}', ',' ORDER BY minute) || ']' AS trend_json
FROM trend GROUP BY adid""",
        "ad_last_hour_sliding": _sliding(60, 1),
        "ad_sliding_2m_1m": _sliding(2, 1),
        "merge_counts": _with("cities", "ev", "clicks", "clicks_t") + """
SELECT day, area, city, adid, count(*) AS clicks FROM clicks_t GROUP BY day, area, city, adid""",
    }
