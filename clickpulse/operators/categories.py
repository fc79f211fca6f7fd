"""Q1 / Q2: categories ranked by clicks, orders, payments; top sessions per category.

P7: each visit row is classified by first match -- click (``click_category_id != -1``),
else order (``order_category_ids`` set), else pay. Order and pay rows count once
per listed id. Counting is a partial + final aggregate on ``category_id``
(low cardinality, so map-side combining removes any skew before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.text import id_list
from clickpulse.operators.topk import top_k_per_group


def category_actions(visits: DataFrame) -> DataFrame:
    """One row per (visit, category) with its action: (category_id, action)."""
    is_click = F.col("click_category_id") != -1
    is_order = F.col("order_category_ids").isNotNull()
    is_pay = F.col("pay_category_ids").isNotNull()
    action = (F.when(is_click, F.lit("click")).when(is_order, F.lit("order"))
              .when(is_pay, F.lit("pay")))
    ids = (F.when(is_click, F.array(F.col("click_category_id")))
           .when(is_order, id_list("order_category_ids"))
           .when(is_pay, id_list("pay_category_ids")))
    return (visits.select(action.alias("action"), F.explode(ids).alias("category_id"))
            .where(F.col("category_id").isNotNull()))


def unreadable_category_ids(visits: DataFrame) -> DataFrame:
    """(action, id_text, mentions): entries of the order and pay lists that are no ids. The counts leave them out;
    this is what they left out (F1)."""
    listed = (F.when(F.col("click_category_id") != -1, F.lit(None)).when(F.col("order_category_ids").isNotNull(), F.struct(F.lit("order").alias("action"), F.col("order_category_ids").alias("ids")))
              .when(F.col("pay_category_ids").isNotNull(), F.struct(F.lit("pay").alias("action"), F.col("pay_category_ids").alias("ids"))))
    entries = visits.select(listed.alias("l")).where("l IS NOT NULL").select("l.action", F.explode(F.split("l.ids", ",")).alias("id_text"))
    return entries.where(F.col("id_text").try_cast("bigint").isNull()).groupBy("action", "id_text").agg(F.count(F.lit(1)).alias("mentions"))


def category_action_counts(visits: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count) for every category seen (A3, A4)."""
    a = F.col("action")
    return (category_actions(visits).groupBy("category_id")
            .agg(F.count_if(a == "click").alias("click_count"),
                 F.count_if(a == "order").alias("order_count"),
                 F.count_if(a == "pay").alias("pay_count")))


def category_top10(visits: DataFrame, n: int = 10) -> DataFrame:
    """Top-n categories by click, then order, then pay count, all descending;
    ties broken by category id (D8). Planned as TakeOrderedAndProject (W5)."""
    return (category_action_counts(visits)
            .orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                     F.asc("category_id"))
            .limit(n))


def category_session_counts(visits: DataFrame) -> DataFrame:
    """Clicks per (category_id, session_id) over click rows (A5)."""
    return (visits.where(F.col("click_category_id") != -1)
            .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def category_session_top10(visits: DataFrame, categories: DataFrame | None = None,
                           n: int = 10, n_categories: int = 10) -> DataFrame:
    """Q2: per category of ``categories`` (default: Q1's top ``n_categories``),
    the ``n`` sessions with most clicks, ties broken by session id (W2, P8, J5).

    Q1's set is broadcast, being bounded by its limit; a caller's set is left to
    the planner, which decides in bytes. The semi join runs on click rows before the
    (category, session) aggregation, so only relevant clicks are shuffled.
    """
    if categories is None:
        cats = F.broadcast(category_top10(visits, n_categories).select("category_id"))
    else:
        cats = categories.select("category_id")
    clicks = (visits.where(F.col("click_category_id") != -1)
              .select(F.col("click_category_id").alias("category_id"), "session_id")
              .join(cats, "category_id", "left_semi"))
    counts = clicks.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))
    return (top_k_per_group(counts, ["category_id"], [F.desc("click_count"), F.asc("session_id")], n)
            .drop("rk"))
