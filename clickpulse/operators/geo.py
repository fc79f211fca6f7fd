"""Q4: top products per area by clicks, with the city share text.

Plan shape (checked with ``explain``):
1. clicks x cities (a dimension) -> partial + final count per (area, city, product): the only shuffle that
   sees click rows, and it carries pre-aggregated counts.
2. one exchange by (area, product) carries these counts to both the totals and the city lists (a list is
   bounded by the number of cities).
3. ``rank()`` per area over the totals, ``rk <= k``: WindowGroupLimit before the
   shuffle, so an area's window only sees ~k rows per task; the share text is made for what is left.
4. products are joined last, to the few survivors (AQE broadcasts the survivors
   when products is large, or the planner broadcasts products when it is small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.share import OTHER_LABEL, share_text
from clickpulse.operators.topk import top_k_per_group


def click_geo(visits: DataFrame, cities: DataFrame) -> DataFrame:
    """Click rows located in their city and area: (area, city_name, click_product_id)."""
    geo = cities.select("city_id", "city_name", "area")
    return (visits.where(F.col("click_product_id") > 0)
            .join(geo, "city_id")
            .select("area", "city_name", "click_product_id"))


def click_geo_counts(visits: DataFrame, cities: DataFrame, weight: str | None = None) -> DataFrame:
    """Clicks per (area, city_name, click_product_id). ``weight`` names a column of
    pre-aggregated click counts (a click log that is already counted)."""
    cols = ["city_id", "click_product_id"] + ([weight] if weight else [])
    v = visits.select(*cols).where(F.col("click_product_id") > 0)
    n = F.sum(weight).cast("long") if weight else F.count(F.lit(1))
    geo = cities.select("city_id", "city_name", "area")
    return (v.join(geo, "city_id")
            .groupBy("area", "city_name", "click_product_id")
            .agg(n.alias("clicks")))


def _product_counts(geo_counts: DataFrame) -> DataFrame:
    return (geo_counts.groupBy("area", "click_product_id")
            .agg(F.sum("clicks").cast("long").alias("product_count")))


def area_product_counts(visits: DataFrame, cities: DataFrame, weight: str | None = None) -> DataFrame:
    """(area, click_product_id, product_count) (A1)."""
    return _product_counts(click_geo_counts(visits, cities, weight))


def area_product_rank(visits: DataFrame, cities: DataFrame, weight: str | None = None) -> DataFrame:
    """Every (area, product) with ``rk = rank() over (area order by product_count desc)``.

    The window runs over an area's distinct counts, not its products: a count's
    rank is one more than the products with a larger one. Ties share a count, so the join back gives them one rank."""
    from pyspark.sql import Window
    counts = area_product_counts(visits, cities, weight)
    larger = (Window.partitionBy("area").orderBy(F.desc("product_count"))
              .rowsBetween(Window.unboundedPreceding, -1))
    ranks = (counts.groupBy("area", "product_count").agg(F.count(F.lit(1)).alias("products"))
             .select("area", "product_count", (F.coalesce(F.sum("products").over(larger), F.lit(0)) + 1).cast("long").alias("rk")))
    return (counts.join(ranks, ["area", "product_count"])
            .select("area", "click_product_id", "product_count", "rk"))


def _city_lists(geo_counts: DataFrame) -> DataFrame:
    """(area, click_product_id, product_count, city_counts): total and city list of every pair, from one exchange."""
    return (geo_counts.groupBy("area", "click_product_id")
            .agg(F.sum("clicks").cast("long").alias("product_count"),
                 F.collect_list(F.struct(F.col("clicks").alias("c"), F.col("city_name").alias("city")))
                 .alias("city_counts")))


def city_click_ratio(visits: DataFrame, cities: DataFrame, top_cities: int = 2,
                     label: str = OTHER_LABEL, weight: str | None = None) -> DataFrame:
    """(area, click_product_id, product_count, city_click_ratio) for every pair (A2)."""
    return (_city_lists(click_geo_counts(visits, cities, weight))
            .select("area", "click_product_id", "product_count",
                    share_text("city_counts", "product_count", top_cities, label)
                    .alias("city_click_ratio")))


def area_product_top3(visits: DataFrame, cities: DataFrame, products: DataFrame, k: int = 3,
                      top_cities: int = 2, label: str = OTHER_LABEL,
                      weight: str | None = None) -> DataFrame:
    """Q4: (area, product_id, product_name, product_count, city_click_ratio, rk).

    ``rank()`` keeps ties, so an area may return more than k products. Products
    whose id is unknown to ``products`` drop out (inner join, as in the reference).
    """
    top = top_k_per_group(_city_lists(click_geo_counts(visits, cities, weight)), ["area"], [F.desc("product_count")], k, ties=True)
    prods = (products.select(F.col("product_id").alias("click_product_id"), "product_name"))
    return (top.join(prods, "click_product_id")
            .select("area",
                    F.col("click_product_id").alias("product_id"),
                    "product_name", "product_count",
                    share_text("city_counts", "product_count", top_cities, label)
                    .alias("city_click_ratio"),
                    "rk"))
