"""Adapters from the TPC-H-like test tables to the click-log data model.

Mapping (fixed by the test-data contract, so every oracle query can repeat it):

* cities   = nation x region: city_id = n_nationkey, city_name = n_name, area = r_name
* products = part: product_id = p_partkey + 1, product_name = p_name, extend_info = p_brand
* users    = customer: user_id = c_custkey, name = c_name, age = 10 + c_custkey % 50,
             professional = c_mktsegment, gender = 'M' when c_custkey % 2 = 0 else 'F'
* visits   = events, with k = int(props.k):
             date / action_time from ts, session_id = user_id || '_' || date,
             page_id = k % 7 + 1, city_id = event_id % 25,
             click:    click_category_id = k % 20 + 1, click_product_id = k + 1 (else -1)
             signup:   order_category_ids = "k%20+1,(k+7)%20+1", order_product_ids = "k+1,(k+7)%100+1"
             purchase: pay_category_ids   = "k%20+1,(k+3)%20+1", pay_product_ids   = "k+1,(k+3)%100+1"
             view:     search_keyword = 'kw_' || k % 6
* clicks   = every event as an ad click: ts = epoch ms, area / city through
             user_id % 25 -> nation -> region, userid = user_id, adid = k % 6 + 1
* lineitem clicks (bench) = lineitem x supplier: city_id = s_nationkey,
             click_product_id = l_partkey + 1, pre-aggregated per (supplier, part).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.session import pin_utc
from clickpulse.sources.tables import read_table

def cities_from_nation(spark: SparkSession, where: str) -> DataFrame:
    nation = read_table(spark, where, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, where, "region").select("r_regionkey", "r_name")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("long").alias("city_id"),
                    F.col("n_name").alias("city_name"),
                    F.col("r_name").alias("area")))


def products_from_part(spark: SparkSession, where: str) -> DataFrame:
    return read_table(spark, where, "part").select(
        (F.col("p_partkey") + 1).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("extend_info"))


def users_from_customer(spark: SparkSession, where: str) -> DataFrame:
    key = F.col("c_custkey")
    return read_table(spark, where, "customer").select(
        key.alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(10) + key % 50).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"))


# The visit columns as SQL over events (with k already extracted).
_VISIT_SQL = [
    "date_format(ts, 'yyyy-MM-dd') AS date",
    "user_id",
    "concat_ws('_', CAST(user_id AS STRING), date_format(ts, 'yyyy-MM-dd')) AS session_id",
    "k % 7 + 1 AS page_id",
    "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS action_time",
    "CASE WHEN event_type = 'view' THEN concat('kw_', CAST(k % 6 AS STRING)) END AS search_keyword",
    "CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1L END AS click_category_id",
    "CASE WHEN event_type = 'click' THEN k + 1 ELSE -1L END AS click_product_id",
    "CASE WHEN event_type = 'signup' THEN concat_ws(',', CAST(k % 20 + 1 AS STRING),"
    " CAST((k + 7) % 20 + 1 AS STRING)) END AS order_category_ids",
    "CASE WHEN event_type = 'signup' THEN concat_ws(',', CAST(k + 1 AS STRING),"
    " CAST((k + 7) % 100 + 1 AS STRING)) END AS order_product_ids",
    "CASE WHEN event_type = 'purchase' THEN concat_ws(',', CAST(k % 20 + 1 AS STRING),"
    " CAST((k + 3) % 20 + 1 AS STRING)) END AS pay_category_ids",
    "CASE WHEN event_type = 'purchase' THEN concat_ws(',', CAST(k + 1 AS STRING),"
    " CAST((k + 3) % 100 + 1 AS STRING)) END AS pay_product_ids",
    "event_id % 25 AS city_id",
    "event_id",
]

_K_SQL = "CAST(try_cast(get_json_object(props, '$.k') AS INT) AS BIGINT) AS k"


def visits_from_events(spark: SparkSession, where: str, params: dict | None = None) -> DataFrame:
    """The visit log; a date range in ``params`` (``startDate``, ``endDate``, both inclusive) reaches the
    scan as a range of ``ts``, which the derived ``date`` text could not."""
    pin_utc(spark)
    ev = read_table(spark, where, "events")
    day = lambda key: F.lit(str((params or {}).get(key) or "").strip()).cast("timestamp_ntz")
    if str((params or {}).get("startDate") or "").strip():
        ev = ev.where(F.col("ts") >= day("startDate"))
    if str((params or {}).get("endDate") or "").strip():
        ev = ev.where(F.col("ts") < day("endDate") + F.expr("INTERVAL 1 DAY"))
    ev = ev.selectExpr("event_id", "ts", "user_id", "event_type", _K_SQL)
    return ev.selectExpr(*_VISIT_SQL)


def clicks_from_events(spark: SparkSession, where: str, first: Column | None = None) -> DataFrame:
    """Ad clicks ``(event_id, ts, area, city, userid, adid)``; ``event_id`` is the
    record id used as order tie-break (the wire format itself has no id). ``first``, a wall-clock timestamp,
    reaches the scan as a bound of the stored time, which the derived epoch ms could not."""
    pin_utc(spark)
    ev = read_table(spark, where, "events")
    if first is not None:
        ev = ev.where(F.col("ts") >= first)
    ev = ev.selectExpr("event_id", "ts", "user_id", _K_SQL)
    geo = cities_from_nation(spark, where).selectExpr("city_id AS geo_key", "city_name AS city", "area")
    return (ev.join(geo, (ev.user_id % 25) == geo.geo_key)
            .selectExpr("event_id", "unix_millis(CAST(ts AS TIMESTAMP)) AS ts", "area", "city",
                        "CAST(user_id AS STRING) AS userid", "CAST(k % 6 + 1 AS STRING) AS adid"))


def click_counts_from_lineitem(spark: SparkSession, where: str) -> DataFrame:
    """Wide click log for the Q4 bench: one click per line item, located at the
    supplier's nation. Output: one (city_id, click_product_id, clicks) row per
    (supplier, part) -- a weighted click log; consumers sum ``clicks``.

    Line items are counted per (supplier, part) before the join, so the shuffles
    move counts, not rows, whatever the suppliers' size.
    """
    li = read_table(spark, where, "lineitem").select("l_suppkey", "l_partkey")
    supp = read_table(spark, where, "supplier").select("s_suppkey", "s_nationkey")
    out = [F.col("s_nationkey").cast("long").alias("city_id"),
           (F.col("l_partkey") + 1).alias("click_product_id")]
    per_supp = li.groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("clicks"))
    return per_supp.join(supp, per_supp.l_suppkey == supp.s_suppkey).select(*out, "clicks")


@dataclass
class AdapterTables:
    """All adapted inputs for one test-data directory. Each is a lazy DataFrame
    defined once and reused (the same logical plan lets Spark reuse exchanges
    when a query reads an input twice)."""
    spark: SparkSession
    where: str
    _memo: dict = field(default_factory=dict, repr=False)

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build(self.spark, self.where)
        return self._memo[name]

    def visits(self, params: dict | None = None) -> DataFrame:
        if params:
            return visits_from_events(self.spark, self.where, params)
        return self._get("visits", visits_from_events)

    def users(self) -> DataFrame:
        return self._get("users", users_from_customer)

    def cities(self) -> DataFrame:
        return self._get("cities", cities_from_nation)

    def products(self) -> DataFrame:
        return self._get("products", products_from_part)

    def clicks(self, first: Column | None = None) -> DataFrame:
        if first is not None:
            return clicks_from_events(self.spark, self.where, first)
        return self._get("clicks", clicks_from_events)

    def lineitem_clicks(self) -> DataFrame:
        return self._get("lineitem_clicks", click_counts_from_lineitem)
