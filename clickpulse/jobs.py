"""The two runnable jobs: offline reports (Q1-Q4 over the Q0-filtered log) and
the ad-click stream (Q5-Q8). Thin compositions of the library functions.

Result tables carry ``task_id`` (one id per run, made by the caller) and are
written through a writer, so parquet, a catalog table or JDBC can be the target.
"""

from __future__ import annotations

import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from clickpulse import operators as op
from clickpulse.plans.lineage import write_and_reread
from clickpulse.sinks.writers import replace_table, with_task_id
from clickpulse.sources.adapters import AdapterTables
from clickpulse.sources.tables import ClickLogTables
from clickpulse.sources.adlog import read_ad_stream
from clickpulse.streaming.ad_stream import start_ad_stream

# The result table names of the original jobs.
OFFLINE_TABLES = ("category_top10", "category_session_top10", "jump_page_ratio", "area_count_info")

Writer = Callable[[DataFrame, str], None]


def parquet_writer(root: str) -> Writer:
    return lambda df, name: replace_table(df, os.path.join(root, name))


def offline_reports(tables: AdapterTables | ClickLogTables, params: dict, task_id: str, flow: str | None = None,
                    k: int = 3) -> dict[str, DataFrame]:
    """Q1, Q2 and Q3 over the Q0-filtered visit log; Q4 over the whole log (as
    the original job did; pass filtered visits to ``area_product_top3`` to change that).

    Q0 is written once to the shared folder: its four readers would otherwise each scan the log."""
    visits = write_and_reread(op.filtered_visits(tables.visits(params), tables.users(), params, cities=tables.cities()), "filtered-visits")
    flow = flow or params.get("targetPageFlow") or "1,2,3,4,5,6,7"
    out = {
        "category_top10": op.category_top10(visits),
        "category_session_top10": op.category_session_top10(visits),
        "jump_page_ratio": op.page_jump_ratio(visits, flow),
        "area_count_info": op.area_product_top3(tables.visits(), tables.cities(), tables.products(), k),
    }
    return {name: with_task_id(df, task_id) for name, df in out.items()}


def run_offline(spark: SparkSession, where: str, params: dict, task_id: str, write: Writer, click_log: bool = False) -> list[str]:
    """``click_log``: ``where`` holds the four tables of a click log; otherwise the test tables, adapted."""
    tables = ClickLogTables(spark, where) if click_log else AdapterTables(spark, where)
    reports = offline_reports(tables, params, task_id)
    for name in OFFLINE_TABLES:
        write(reports[name], name)
    return list(OFFLINE_TABLES)


def run_stream(spark: SparkSession, state_root: str, checkpoint: str, path: str | None = None,
               kafka: dict | None = None, threshold: int = op.ads.DEFAULT_THRESHOLD,
               processing_time: str = "5 seconds", available_now: bool = False, **options):
    """Start the ad stream on Kafka (options) or a folder of text files. ``options``: those of ``AdStreamJob``."""
    lines = read_ad_stream(spark, path=path, kafka=kafka)
    return start_ad_stream(lines, state_root, checkpoint, threshold=threshold,
                           processing_time=processing_time, available_now=available_now, **options)
