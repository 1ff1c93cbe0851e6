"""Every registered query runs on the smallest tables and equals its SQL twin
(DuckDB over the same parquet files)."""

import os
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(k for k in entry.queries() if k != "pipeline" and not re.match(r"op\d", k))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["key", "doc_count", "avg_value"]
    assert df.count() > 0


def test_every_query_has_sql_or_is_documented():
    without = set(entry.queries()) - set(entry.oracle_sql())
    # the optional training-data queries without SQL have brute-force tests of their own
    assert {k for k in without if k != "pipeline" and not k.startswith("op")} == set()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF)
    srows = [r.asDict() for r in sdf.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert isinstance(srows, list)
        return
    res = con.sql(sql)
    drows = [dict(zip(res.columns, r)) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(res.columns)
    cols = sorted(sdf.columns)
    assert rows_of(srows, cols) == rows_of(drows, cols)
