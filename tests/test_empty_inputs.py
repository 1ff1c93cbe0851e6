"""Every registered query on empty tables of the same schemas equals its SQL
twin (no rows, or one row of NULLs / zeros for global aggregates). The
non-empty check is the one query that must refuse."""

import os
import re
import sys
import tempfile

import duckdb
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

SRC = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def empty_dir():
    d = tempfile.mkdtemp(prefix="docsift-empty-")
    for t in TABLES:
        tab = pq.read_table(f"{SRC}/{t}.parquet")
        pq.write_table(tab.slice(0, 0), f"{d}/{t}.parquet")
    return d


@pytest.fixture(scope="module")
def con(empty_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{empty_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(k for k in entry.queries() if k != "pipeline" and not re.match(r"op\d", k)))
def test_query_on_empty_tables(spark, con, empty_dir, key):
    fn = entry.queries()[key]
    if key == "require_rows":
        with pytest.raises(LookupError):
            fn(spark, empty_dir)
        return
    sdf = fn(spark, empty_dir)
    srows = [r.asDict() for r in sdf.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert srows == [] or all(v in (None, 0) for r in srows for k, v in r.items() if k != "key")
        return
    res = con.sql(sql)
    drows = [dict(zip(res.columns, r)) for r in res.fetchall()]
    cols = sorted(sdf.columns)
    assert cols == sorted(res.columns)
    assert rows_of(srows, cols) == rows_of(drows, cols)
