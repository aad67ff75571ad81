"""Catalog queries against their DuckDB oracle on the smallest driver data."""

import duckdb
import pytest

import __spark_entry__ as entry
from eventlake.plans import catalog
from eventlake.sources.tables import TABLES
from tools_check import digest

@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, small_dir, name):
    df = entry.queries()[name](spark, small_dir)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, rows)[0] == digest(rel.columns, rel.fetchall())[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
