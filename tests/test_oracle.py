"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import digest
from tools.type_check import SPARK_TO_DUCKDB
from martworks.plans.registry import QUERIES
from martworks.plans.testdata import ALL_TABLES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ALL_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(entry.oracle_sql())
    assert not missing


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[name])
    otypes = dict(zip(rel.columns, [str(t).replace(" ", "") for t in rel.types]))
    for col, dtype in df.dtypes:
        assert otypes.get(col) == SPARK_TO_DUCKDB.get(dtype, dtype.upper().replace(" ", "")), col
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_views" in df.columns
