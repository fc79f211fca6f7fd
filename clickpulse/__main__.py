"""Command line: ``python -m clickpulse offline|stream ...`` (the launcher sets the master)."""

from __future__ import annotations

import argparse
import json
import uuid

from clickpulse.jobs import parquet_writer, run_offline, run_stream
from clickpulse.session import get_session


def main(argv=None):
    ap = argparse.ArgumentParser(prog="clickpulse")
    sub = ap.add_subparsers(dest="cmd", required=True)
    o = sub.add_parser("offline", help="Q1-Q4 result tables")
    o.add_argument("--tables", required=True, help="folder of <table>.parquet inputs")
    o.add_argument("--click-log", action="store_true", help="the inputs are a click log's own four tables (--tables catalog: from the catalog)")
    o.add_argument("--out", required=True, help="folder for the result tables")
    o.add_argument("--params", default="{}", help="JSON object of filter parameters")
    o.add_argument("--task-id", default=None)
    s = sub.add_parser("stream", help="Q5-Q8 on an ad-click stream")
    s.add_argument("--source", help="folder of text files (one CSV line per click)")
    s.add_argument("--kafka", default=None, help="JSON object of Kafka source options")
    s.add_argument("--state", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--threshold", type=int, default=100)
    s.add_argument("--trend-minutes", type=int, default=60)
    s.add_argument("--lateness-minutes", type=int, default=None, help="clicks that much behind the newest minute are rejected as late")
    s.add_argument("--keep-rows", action="store_true", help="write the surviving clicks too")
    s.add_argument("--top-k", type=int, default=3)
    s.add_argument("--processing-time", default="5 seconds")
    s.add_argument("--available-now", action="store_true")
    a = ap.parse_args(argv)
    spark = get_session()
    if a.cmd == "offline":
        task = a.task_id or str(uuid.uuid4())
        names = run_offline(spark, a.tables, json.loads(a.params), task, parquet_writer(a.out), click_log=a.click_log)
        print(json.dumps({"task_id": task, "tables": names}))
    else:
        _, q = run_stream(spark, a.state, a.checkpoint, path=a.source,
                          kafka=json.loads(a.kafka) if a.kafka else None,
                          threshold=a.threshold, available_now=a.available_now, processing_time=a.processing_time,
                          trend_minutes=a.trend_minutes, lateness_minutes=a.lateness_minutes,
                          keep_rows=a.keep_rows, top_k=a.top_k)
        q.awaitTermination()


if __name__ == "__main__":
    main()
