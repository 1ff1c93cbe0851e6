"""Exact quantiles split by value range, checked against a brute-force
computation on small hand-made frames: a hot group spanning many slices,
duplicated values, NULL values and a NULL group key."""

import math
import random

import pytest
from pyspark.sql import functions as F

from docsift.operators import metrics as M
from docsift.operators.quantiles import exact_quantiles


def _brute(values, f):
    v = sorted(values)
    if not v:
        return None
    pos = f * (len(v) - 1)
    lo, hi = v[math.floor(pos)], v[math.ceil(pos)]
    return lo + (pos - math.floor(pos)) * (hi - lo)


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 400))) for _ in range(3000)]          # a third and more
    rows += [(f"g{i % 40}", float(rnd.randint(-50, 50))) for i in range(2000)]
    rows += [("one", 5.0), ("nulls", None), (None, 1.0), (None, 3.0), (None, 10.0)]
    return spark.createDataFrame(rows, "g string, x double")


FR = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def test_exact_quantiles_match_brute_force(skewed):
    got = {r.g: r for r in exact_quantiles(skewed, ["g"], "x", FR, slices=16).collect()}
    by = {}
    for r in skewed.collect():
        if r.x is not None:
            by.setdefault(r.g, []).append(r.x)
    assert set(got) == set(by)          # the all-NULL group has no row
    for g, vals in by.items():
        for i, f in enumerate(FR):
            assert got[g][f"_q{i}"] == pytest.approx(_brute(vals, f), abs=1e-9), (g, f)


def test_hot_group_spans_many_slices(skewed):
    # the hot group alone is range-split: its distinct values fall into
    # several partitions, none of which holds the whole group (the same
    # partitioning exact_quantiles(..., slices=16) uses)
    counted = skewed.groupBy("g", "x").count()
    parts = counted.repartitionByRange(16, "g", "x").withColumn("p", F.spark_partition_id())
    assert parts.filter(F.col("g") == "hot").select("p").distinct().count() > 2


def test_global_quantiles_and_empty_input(spark, skewed):
    row = exact_quantiles(skewed, [], "x", [0.5], names=["m"], slices=7).collect()
    vals = [r.x for r in skewed.collect() if r.x is not None]
    assert len(row) == 1 and row[0].m == pytest.approx(_brute(vals, 0.5))
    empty = skewed.filter(F.lit(False))
    row = exact_quantiles(empty, [], "x", [0.5], names=["m"]).collect()
    assert len(row) == 1 and row[0].m is None


def test_percentiles_and_mad_metrics_keep_null_key(skewed):
    out = {r.key: r for r in M.aggregate(skewed.withColumnRenamed("g", "key"), ["key"], {
        "v": M.percentiles("x", [50]), "d": M.median_absolute_deviation("x")}).collect()}
    nul = out[None]
    assert nul.doc_count == 3 and nul.v_p50 == 3.0 and nul.d == 2.0
    assert out["nulls"].v_p50 is None and out["nulls"].d is None


def test_fraction_out_of_range():
    with pytest.raises(ValueError):
        M.percentiles("x", [150])


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                          st.one_of(st.none(), st.integers(-5, 5).map(float),
                                    st.floats(-1e6, 1e6, allow_nan=False))), min_size=1, max_size=60),
       st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_property(spark, rows, fractions):
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r for r in exact_quantiles(df, ["g"], "x", fractions, slices=5).collect()}
    by = {}
    for g, x in rows:
        if x is not None:
            by.setdefault(g, []).append(x)
    assert set(got) == set(by)
    for g, vals in by.items():
        for i, f in enumerate(fractions):
            assert got[g][f"_q{i}"] == pytest.approx(_brute(vals, f), rel=1e-9, abs=1e-6)
