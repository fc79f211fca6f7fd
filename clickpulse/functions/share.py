"""City share text (A2, replaces the reference's map-buffer UDAF).

Input per group: an array of ``struct(c, city)`` (one entry per city -- bounded
by the number of cities, never by rows) and the group total ``n``.
Output text: the ``top`` cities by (count desc, name asc) as ``name:pct%`` with
``pct = floor(c * 1000 / n + 0.5) / 10``, then the residual bucket
``label:other%``, the same share of the clicks of all other cities (defect D1
fixed; from counts, so it is never negative), always emitted, comma-joined.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: the reference's label for the residual bucket is the Chinese
# word for "other" (其他); this engine defaults to the English word and takes
# the label as a parameter.
OTHER_LABEL = "other"


def share_text(city_counts: str, total: str, top: int = 2, label: str = OTHER_LABEL) -> Column:
    """``city_counts``: name of an ``array<struct<c:bigint, city:string>>`` column;
    ``total``: name of the group-total column. One SQL expression (JVM-side)."""
    return F.expr(_share_sql(f"`{city_counts}`", f"`{total}`", top, label))


def _share_sql(city_counts: str, total: str, top: int, label: str) -> str:
    lab = label.replace("\\", "\\\\").replace("'", "\\'")
    # Ascending sort on (-count, city) = count desc, then name asc (defect D21).
    shown = (f"slice(array_sort(transform({city_counts}, x -> struct(-x.c AS nc, x.city AS city))), 1, {top})")
    pct = f"floor(-x.nc * 1000.0D / {total} + 0.5D) / 10.0D"
    head = f"array_join(transform({shown}, x -> concat(x.city, ':', CAST({pct} AS STRING), '%')), ',')"
    rest = f"({total} - aggregate({shown}, 0L, (acc, x) -> acc - x.nc))"
    other = f"floor({rest} * 1000.0D / {total} + 0.5D) / 10.0D"
    return f"concat({head}, ',', '{lab}:', CAST({other} AS STRING), '%')"


def register_city_ratio(spark: SparkSession, name: str = "cityRatio", top: int = 2, label: str = OTHER_LABEL) -> None:
    """The share text as a SQL function over an aggregated city list (X1): ``cityRatio(collect_list(struct(clicks AS c, city_name AS city)))``
    over counts by city, so that a list holds an entry for each city, not for each click. A SQL-defined function: Catalyst puts its
    body in place of the call, nothing leaves the JVM."""
    total = "aggregate(city_counts, 0L, (acc, x) -> acc + x.c)"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(city_counts ARRAY<STRUCT<c: BIGINT, city: STRING>>) RETURNS STRING "
              f"RETURN {_share_sql('city_counts', total, top, label)}")
