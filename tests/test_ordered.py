"""Positions, running sums and look-backs computed over range slices equal
plain ordered windows (the brute-force reference) on hand-made bucket tables
with a parent holding most buckets, NULL metrics and a NULL parent key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from docsift.operators import bucket_series as S
from docsift.operators.ordered import positions


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    # blocks of 7 positions, so look-backs and frames cross block borders
    monkeypatch.setattr(S, "BLOCK_ROWS", 7)


@pytest.fixture(autouse=True)
def no_coalesce(spark):
    # tiny frames: keep AQE from merging all range slices into one, so the
    # offsets carried across slices are exercised
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


@pytest.fixture(scope="module")
def buckets(spark):
    rnd = random.Random(3)
    rows = [("big", k, None if k % 7 == 0 else float(rnd.randint(-20, 20))) for k in range(400)]
    rows += [(f"p{i}", k, float(k * i)) for i in range(5) for k in range(i + 1)]
    rows += [(None, k, float(k)) for k in range(3)]
    return spark.createDataFrame(rows, "parent string, key int, v double")


def _rows(df, cols):
    def norm(v):
        return ("~",) if v is None else (round(v, 9) if isinstance(v, float) else v,)
    return sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())


def test_positions_and_running_sum_equal_window(buckets):
    # the big parent spans several slices
    sliced = buckets.repartitionByRange(8, "parent", "key").withColumn("p", F.spark_partition_id())
    assert sliced.filter(F.col("parent") == "big").select("p").distinct().count() > 3
    got = positions(buckets, ["parent"], [F.col("key").asc()], sums={"cum": F.col("v")}, totals=True, slices=8)
    w = Window.partitionBy("parent").orderBy("key")
    want = buckets.select("*", (F.row_number().over(w) - 1).alias("_pos"),
                          F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                          F.sum("v").over(Window.partitionBy("parent")).alias("cum_total"),
                          F.count(F.lit(1)).over(Window.partitionBy("parent")).alias("_n"))
    cols = ["parent", "key", "v", "_pos", "cum", "cum_total", "_n"]
    assert _rows(got, cols) == _rows(want, cols)


@pytest.mark.parametrize("pb", [[], ["parent"]])
def test_pipelines_equal_windows(buckets, pb):
    bt = buckets if pb else buckets.filter(F.col("parent") == "big").drop("parent")
    w = (Window.partitionBy(*pb) if pb else Window.partitionBy()).orderBy("key")
    cols = [*pb, "key", "v", "x"]
    checks = [
        (S.cumulative_sum(bt, "v", "x", partition_by=pb),
         F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))),
        (S.derivative(bt, "v", "x", partition_by=pb), F.col("v") - F.lag("v", 1).over(w)),
        (S.serial_diff(bt, "v", "x", lag=5, partition_by=pb), F.col("v") - F.lag("v", 5).over(w)),
        (S.moving_fn(bt, "v", "x", window=4, partition_by=pb), F.avg("v").over(w.rowsBetween(-4, -1))),
        (S.moving_fn(bt, "v", "x", window=3, fn="std", shift=1, partition_by=pb),
         F.stddev_pop("v").over(w.rowsBetween(-2, 0))),
        (S.moving_fn(bt, "v", "x", window=2, fn="max", partition_by=pb), F.max("v").over(w.rowsBetween(-2, -1))),
    ]
    for got, expr in checks:
        assert _rows(got, cols) == _rows(bt.withColumn("x", expr), cols)


def test_bucket_sort_pages(buckets):
    bt = buckets.filter(F.col("parent") == "big").drop("parent")
    order = [F.col("v").desc_nulls_last(), F.col("key").asc()]
    full = [r.key for r in bt.orderBy(*order).collect()]
    assert [r.key for r in S.bucket_sort(bt, order, from_=3, size=5).collect()] == full[3:8]
    got = S.bucket_sort(bt, order, from_=390).collect()
    assert sorted(r.key for r in got) == sorted(full[390:])
    per = S.bucket_sort(buckets, [F.col("key").desc()], size=2, partition_by=["parent"]).collect()
    assert sorted((r.parent or "", r.key) for r in per) == sorted(
        [("", 2), ("", 1), ("big", 399), ("big", 398), ("p0", 0)] + [(f"p{i}", k) for i in range(1, 5)
                                                                     for k in (i, i - 1)])


def test_moving_fn_any_shift_equals_window(buckets):
    bt = buckets.filter(F.col("parent") == "big").drop("parent")
    w = Window.partitionBy().orderBy("key")
    for window, shift in [(1, 0), (3, 2), (4, -2), (2, 5), (9, 0)]:
        got = S.moving_fn(bt, "v", "x", window=window, fn="sum", shift=shift)
        want = bt.withColumn("x", F.sum("v").over(w.rowsBetween(-window + shift, -1 + shift)))
        assert _rows(got, ["key", "v", "x"]) == _rows(want, ["key", "v", "x"])
    with pytest.raises(ValueError):
        S.moving_fn(bt, "v", "x", window=0)


def test_top_n_per_group_slices_path_with_skip(spark, buckets):
    from docsift.operators.ordered import top_n_per_group

    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    old = spark.conf.get(key)
    order = [F.col("v").desc_nulls_last(), F.col("key").asc()]
    w = Window.partitionBy("parent").orderBy(*order)
    want = buckets.withColumn("r", F.row_number().over(w)).filter((F.col("r") > 3) & (F.col("r") <= 8))
    spark.conf.set(key, "1")                     # force the range-slice path
    try:
        got = top_n_per_group(buckets, ["parent"], order, 5, skip=3, rank="r")
        cols = ["parent", "key", "v", "r"]
        assert _rows(got, cols) == _rows(want, cols)
    finally:
        spark.conf.set(key, old)


def test_empty_bucket_tables(spark, buckets):
    empty = buckets.filter(F.lit(False))
    assert S.cumulative_sum(empty, "v", "x", partition_by=["parent"]).count() == 0
    assert S.derivative(empty, "v", "x").count() == 0
    assert S.moving_fn(empty, "v", "x", window=3).count() == 0
    assert S.bucket_sort(empty, [F.col("key")], from_=1).count() == 0
    row = S.siblings(empty.drop("parent"), "v", "s", percents=[50]).collect()
    assert len(row) == 1 and row[0].s_count == 0 and row[0].s_p50 is None


def test_serial_diff_negative_lag_looks_ahead(buckets):
    w = Window.partitionBy("parent").orderBy("key")
    got = S.serial_diff(buckets, "v", "x", lag=-3, partition_by=["parent"])
    want = buckets.withColumn("x", F.col("v") - F.lead("v", 3).over(w))
    cols = ["parent", "key", "v", "x"]
    assert _rows(got, cols) == _rows(want, cols)
