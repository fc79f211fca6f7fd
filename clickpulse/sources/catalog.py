"""Named views for SQL users.

The library itself passes DataFrames around; these views only let existing
SQL text that reads the original table names run unchanged on the adapted data.
``createOrReplaceTempView`` replaces, so running twice in one session works
(defect D14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickpulse.functions.share import register_city_ratio
from clickpulse.sources.adapters import AdapterTables

# The table names the original SQL reads.
VIEW_NAMES = {
    "user_visit_action": "visits",
    "user_info": "users",
    "city_info": "cities",
    "product_info": "products",
}


def register_views(tables: AdapterTables, extra: dict[str, DataFrame] | None = None) -> list[str]:
    """Register the adapted tables under their original names, and the SQL function ``cityRatio``; returns the views' names."""
    register_city_ratio(tables.spark)
    for view, attr in VIEW_NAMES.items():
        getattr(tables, attr)().createOrReplaceTempView(view)
    for view, df in (extra or {}).items():
        df.createOrReplaceTempView(view)
    return list(VIEW_NAMES) + list(extra or {})


#: Q4 as SQL text on the registered views: the original's steps, with clicks counted by city before the share.
AREA_PRODUCT_TOP3_SQL = """
WITH tmp_area_product AS (
  SELECT ci.area, ci.city_name, uv.click_product_id
  FROM user_visit_action uv JOIN city_info ci ON uv.city_id = ci.city_id WHERE uv.click_product_id > 0),
tmp_city_count AS (
  SELECT area, click_product_id, city_name, count(*) AS clicks FROM tmp_area_product GROUP BY area, click_product_id, city_name),
tmp_area_product_count AS (
  SELECT area, click_product_id, sum(clicks) AS product_count, cityRatio(collect_list(struct(clicks AS c, city_name AS city))) AS city_click_ratio
  FROM tmp_city_count GROUP BY area, click_product_id),
tmp_sorted_area_product AS (
  SELECT area, click_product_id, product_count, city_click_ratio, rank() OVER (PARTITION BY area ORDER BY product_count DESC) AS rk FROM tmp_area_product_count)
SELECT area, product_id, product_name, product_count, city_click_ratio, CAST(rk AS BIGINT) AS rk
FROM tmp_sorted_area_product JOIN product_info ON click_product_id = product_id WHERE rk <= 3"""


def area_product_top3_sql(tables: AdapterTables) -> DataFrame:
    """Q4 from its SQL text."""
    register_views(tables)
    return tables.spark.sql(AREA_PRODUCT_TOP3_SQL)
