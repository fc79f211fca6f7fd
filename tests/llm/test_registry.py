"""Every registered query of the package against its SQL, or a plain version of the same thing, on whole small tables."""

import duckdb
import pytest

import __spark_entry__ as E
from clickpulse.llm import registry
from tests.conftest import SF_SMALL
from tools.oracle_check import digest

TABLES = ("documents", "embeddings", "conversations")


def test_all_operators_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {int(n[2:].split("_")[0]) for n in registry.queries()} == set(range(1, 14))
    assert set(registry.queries()) <= names and "pipeline" in names
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_query_matches_its_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = registry.queries()[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(registry.oracle_sql()[key])
    want = rel.fetchall()
    assert len(got) == len(want)
    assert digest(df.columns, got)[:2] == digest(rel.columns, want)[:2]
