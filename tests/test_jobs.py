"""The runnable jobs."""

import os

from clickpulse.jobs import OFFLINE_TABLES, parquet_writer, run_offline
from tests.conftest import SF_SMALL


def test_offline_job_writes_four_tables_with_task_id(spark, scratch):
    params = {"startDate": "2024-01-01", "endDate": "2024-01-31", "startAge": "20", "endAge": "50",
              "professionals": "", "city": "", "gender": "", "keywords": "", "categoryIds": "",
              "targetPageFlow": "1,2,3,4,5,6,7"}
    names = run_offline(spark, SF_SMALL, params, "t-1", parquet_writer(scratch))
    assert names == list(OFFLINE_TABLES)
    for name in names:
        df = spark.read.parquet(os.path.join(scratch, name))
        assert df.columns[0] == "task_id"
        assert df.count() > 0 and {r.task_id for r in df.select("task_id").distinct().collect()} == {"t-1"}
    ratio = spark.read.parquet(os.path.join(scratch, "jump_page_ratio"))
    assert ratio.count() == 6


def test_command_line_offline(scratch):
    import json
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(scratch, "reports")
    params = json.dumps({"startDate": "2024-01-01", "endDate": "2024-01-31"})
    r = subprocess.run([sys.executable, "-m", "clickpulse", "offline", "--tables", SF_SMALL, "--out", out,
                        "--params", params, "--task-id", "cli"],
                       cwd=root, capture_output=True, text=True, timeout=600,
                       env={**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell"})
    assert r.returncode == 0, r.stderr[-2000:]
    assert json.loads(r.stdout.strip().splitlines()[-1]) == {"task_id": "cli", "tables": list(OFFLINE_TABLES)}
    assert sorted(os.listdir(out)) == sorted(OFFLINE_TABLES)
