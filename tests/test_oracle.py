"""Every registered query equals its DuckDB oracle (rows, column names, values)."""

import duckdb
import pytest

import __spark_entry__ as E
from clickpulse.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.oracle_check import digest

KEYS = sorted(E.click_log_queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.click_log_oracle_sql()) == set(E.click_log_queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.click_log_queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.click_log_oracle_sql()[key])
    orows = rel.fetchall()
    cs, hs, _ = digest(df.columns, rows)
    co, ho, _ = digest(rel.columns, orows)
    assert cs == co
    assert len(rows) == len(orows)
    assert hs == ho


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["area", "product_id", "product_name", "product_count", "city_click_ratio", "rk"]
    assert df.count() > 0


def test_limits_only_where_they_are_the_feature():
    for key, sql in E.click_log_oracle_sql().items():
        if " LIMIT " in sql.upper().replace("\n", " "):
            assert "top10" in key, key
