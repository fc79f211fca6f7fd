"""Writers and manifests."""

import os

from pyspark.sql import functions as F

from clickpulse.plans import cut_lineage, write_and_reread
from clickpulse.session import checkpoint_dir
from clickpulse.sinks import Manifests, SharedFiles, replace_table, upsert_partitions
from clickpulse.sinks.manifests import KEPT
from clickpulse.sources import read_ad_lines
from clickpulse.sinks.writers import write_ad_log
from tests import helpers as h


def _s(df):
    return sorted(map(tuple, df.collect()))


def test_upsert_replaces_only_touched_days(spark, scratch):
    path = os.path.join(scratch, "counts")
    a = spark.createDataFrame([("d1", "x", 1), ("d2", "x", 2)], "day string, k string, clicks bigint")
    upsert_partitions(a, path, ["day"])
    b = spark.createDataFrame([("d2", "x", 5), ("d2", "y", 1)], "day string, k string, clicks bigint")
    upsert_partitions(b, path, ["day"])
    upsert_partitions(b, path, ["day"])      # replay: same result
    got = spark.read.parquet(path).select("day", "k", "clicks")
    assert _s(got) == [("d1", "x", 1), ("d2", "x", 5), ("d2", "y", 1)]


def test_replace_table_path(spark, scratch):
    p = os.path.join(scratch, "t")
    replace_table(spark.range(3), p)
    replace_table(spark.range(2), p)
    assert spark.read.parquet(p).count() == 2


def test_lineage_cuts_use_shared_folder(spark):
    d = checkpoint_dir(spark)
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert cut_lineage(df).count() == 10
    back = write_and_reread(df, "probe")
    assert back.count() == 10 and d in back.inputFiles()[0]


def test_ad_log_text_sink_roundtrip(spark, scratch):
    c = h.clicks(spark, [(h.ms("2019-11-26 10:00:00"), "north", "bj", "3", "5")], with_id=False)
    p = os.path.join(scratch, "adlog")
    write_ad_log(c, path=p)
    assert [r.value for r in read_ad_lines(spark, p).collect()] == [f"{h.ms('2019-11-26 10:00:00')},north,bj,3,5"]


def test_replace_catalog_table(spark):
    replace_table(spark.range(5), "clickpulse_replace_probe")
    replace_table(spark.range(3), "clickpulse_replace_probe")     # drop-and-replace, rerunnable
    assert spark.table("clickpulse_replace_probe").count() == 3


def test_manifests_name_what_belongs_together_and_remove_the_rest(spark, scratch):
    m, files = Manifests(spark, scratch), SharedFiles(spark)
    served = {}
    for n in range(50):
        for day in {n // 10, 4 - n % 5}:          # each batch changes a day or two
            os.makedirs(os.path.join(scratch, "out", f"batch={n}", f"day={day}"))
            served[day] = n
        m.publish({"batch": n, "folders": [f"out/batch={b}/day={d}" for d, b in served.items()]})
        assert m.newest()["batch"] == n
        for b in m.batches():                      # whatever a reader holds is there whole
            assert all(files.exists(os.path.join(scratch, f)) for f in m.get(b)["folders"])
    assert len(m.batches()) == KEPT
    left = [f for b in files.names(os.path.join(scratch, "out")) for f in files.names(os.path.join(scratch, "out", b))]
    assert len(left) <= len(served) + 2 * KEPT
    assert m.get(3) is None and m.get(-1) is None


def test_text_files_appear_whole(spark, scratch):
    files = SharedFiles(spark)
    path = os.path.join(scratch, "a", "note")
    files.write(path, "one")
    files.write(path, "zwei \u00e9")
    assert files.read(path) == "zwei \u00e9" and files.names(os.path.dirname(path)) == ["note"] or files.names(os.path.dirname(path)) == [".note.crc", "note"]
    assert files.names(os.path.join(scratch, "nothing")) == []
