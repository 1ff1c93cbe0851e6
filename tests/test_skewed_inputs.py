"""Every registered query on skewed copies of the given tables equals its SQL
twin. In each table the last third of the rows takes the values of the first
row in every non-key column, so each grouping, join, sort and text column has
one value holding a third of all rows (keys stay unique, as the data model
requires)."""

import os
import sys
import tempfile

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

SRC = "/root/testdata/sf0.001"
KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
        "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
        "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
        "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"],
        "conversations": ["conv_id", "turn"]}


def _skew(tab: pa.Table, keys) -> pa.Table:
    n = tab.num_rows
    cut = n - n // 3
    cols = []
    for name in tab.column_names:
        col = tab.column(name).combine_chunks()
        if name in keys or n - cut == 0:
            cols.append(col)
        else:
            hot = pa.concat_arrays([col.slice(0, 1)] * (n - cut))
            cols.append(pa.concat_arrays([col.slice(0, cut), hot]))
    return pa.table(cols, names=tab.column_names)


@pytest.fixture(scope="module")
def skewed_dir():
    d = tempfile.mkdtemp(prefix="docsift-skew-")
    for t in TABLES:
        pq.write_table(_skew(pq.read_table(f"{SRC}/{t}.parquet"), KEYS[t]), f"{d}/{t}.parquet")
    return d


@pytest.fixture(scope="module")
def con(skewed_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{skewed_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_on_skewed_tables(spark, con, skewed_dir, key):
    sdf = entry.queries()[key](spark, skewed_dir)
    srows = [r.asDict() for r in sdf.collect()]
    res = con.sql(entry.oracle_sql()[key])
    drows = [dict(zip(res.columns, r)) for r in res.fetchall()]
    cols = sorted(sdf.columns)
    assert cols == sorted(res.columns)
    assert rows_of(srows, cols) == rows_of(drows, cols)
