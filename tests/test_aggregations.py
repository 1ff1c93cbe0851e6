import datetime as dt
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from docsift.functions import predicates as P
from docsift.operators import bucket_series as S
from docsift.operators import buckets as B
from docsift.operators import metrics as M
from docsift.plans.search import aggs, execute, query


@pytest.fixture(scope="module")
def flowers(spark):
    # three species with equal counts: terms ties must come out alphabetically
    rows = []
    for i, sp in enumerate(["virginica", "setosa", "versicolor"] * 4):
        rows.append((i, sp, float(i % 5), None if i == 0 else float(i)))
    return spark.createDataFrame(rows, "id int, species string, width double, maybe double")


def test_terms_ties_alphabetical(flowers):
    out = execute(flowers, aggs(s=B.terms("species", metrics={"w": M.avg("width")}))).collect()
    assert [r.key for r in out] == ["setosa", "versicolor", "virginica"]
    assert all(r.doc_count == 4 for r in out)


def test_terms_options(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",), ("c",), ("c",)], "k string")
    out = B.terms("k", size=2).run(df).collect()
    assert [(r.key, r.doc_count) for r in out] == [("c", 3), ("a", 2)]
    out = B.terms("k", size=None, missing="?").run(df).collect()
    assert ("?", 1) in [(r.key, r.doc_count) for r in out]
    out = B.terms("k", size=None, min_doc_count=2, exclude="c").run(df).collect()
    assert [r.key for r in out] == ["a"]
    out = B.terms("k", size=None, include="[ab]", order=[("_key", "desc")]).run(df).collect()
    assert [r.key for r in out] == ["b", "a"]


def test_metrics_match_python(flowers):
    vals = [float(i % 5) for i in range(12)]
    row = execute(flowers, aggs(st=M.extended_stats("width"), p=M.percentiles("width", [50]),
                                mad=M.median_absolute_deviation("width"),
                                pr=M.percentile_ranks("width", [2]),
                                c=M.cardinality("width"), vc=M.value_count("maybe"))).first()
    n = len(vals)
    mean = sum(vals) / n
    var = sum((v - mean) ** 2 for v in vals) / n
    assert row.st_count == n and row.st_sum == sum(vals)
    assert math.isclose(row.st_variance, var) and math.isclose(row.st_std_upper, mean + 2 * math.sqrt(var))
    srt = sorted(vals)
    med = (srt[5] + srt[6]) / 2
    assert row.p_p50 == med
    devs = sorted(abs(v - med) for v in vals)
    assert row.mad == (devs[5] + devs[6]) / 2
    assert math.isclose(row.pr_2, 100 * sum(v <= 2 for v in vals) / n)
    assert row.c == 5 and row.vc == 11


def test_weighted_and_matrix(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0), (None, 5.0), (2.0, None)], "v double, w double")
    row = execute(df, aggs(wa=M.weighted_avg("v", "w"), m=M.matrix_stats(["v", "w"]))).first()
    assert row.wa == (1 * 1 + 3 * 3) / 4
    assert row.m_count == 2 and row.m_v_w_correlation == pytest.approx(1.0)


def test_string_stats_entropy(spark):
    df = spark.createDataFrame([("aab",), ("b",), (None,)], "s string")
    row = execute(df, aggs(s=M.string_stats("s"))).first()
    p = [2 / 4, 2 / 4]
    assert row.s_count == 2 and row.s_min_length == 1 and row.s_max_length == 3
    assert row.s_entropy == pytest.approx(-sum(x * math.log2(x) for x in p))


def test_histograms_fill_gaps(spark):
    df = spark.createDataFrame([(1.0,), (2.5,), (9.0,)], "x double")
    out = B.histogram("x", 2, min_doc_count=0).run(df).collect()
    assert [(r.key, r.doc_count) for r in out] == [(0.0, 1), (2.0, 1), (4.0, 0), (6.0, 0), (8.0, 1)]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1),), (dt.datetime(2024, 1, 3, 5),)], "t timestamp_ntz")
    out = B.date_histogram("t", calendar_interval="day", min_doc_count=0).run(ts).collect()
    assert [r.doc_count for r in out] == [1, 0, 1]
    out = B.date_histogram("t", fixed_interval="12 hours").run(ts).collect()
    assert [r.key for r in out] == [dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 3, 0)]


def test_overlapping_ranges_filters_adjacency(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 15.0), (3, 25.0)], "id int, x double")
    out = B.range_("x", [("lo", None, 20.0), ("mid", 10.0, 30.0), ("none", 100.0, None)]).run(df).collect()
    assert [(r.key, r.doc_count) for r in out] == [("lo", 2), ("mid", 2), ("none", 0)]
    f = {"a": P.range_("x", lt=20), "b": P.range_("x", gt=10)}
    out = B.filters(f, other_bucket_key="rest").run(df).collect()
    assert [(r.key, r.doc_count) for r in out] == [("a", 2), ("b", 2), ("rest", 0)]
    out = B.adjacency_matrix(f).run(df).collect()
    assert [(r.key, r.doc_count) for r in out] == [("a", 2), ("a&b", 1), ("b", 2)]


def test_composite_after_and_sub_terms(spark):
    rows = [("x", 1), ("x", 1), ("x", 2), ("y", 1), ("y", 3), ("y", 3), ("y", 3), ("z", 9)]
    df = spark.createDataFrame(rows, "a string, b int")
    page = B.composite([("a", "a"), ("b", "b")], size=2, after=("x", 1)).run(df).collect()
    assert [(r.a, r.b) for r in page] == [("x", 2), ("y", 1)]
    out = B.sub_terms([("a", "a", 2), ("b", "b", 1)]).run(df).collect()
    assert [(r.a, r.a_doc_count, r.b, r.b_doc_count) for r in out] == [("x", 3, 1, 2), ("y", 4, 3, 3)]


def test_top_hits_with_hot_bucket(spark):
    rows = [(("hot" if i % 10 else "cold"), i, float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, id int, v double")
    want = [("cold", 1, 1990), ("cold", 2, 1980), ("cold", 3, 1970),
            ("hot", 1, 1999), ("hot", 2, 1998), ("hot", 3, 1997)]
    out = B.top_hits(df, ["g"], 3, [F.col("v").desc(), F.col("id").asc()]).collect()
    assert sorted((r.g, r.rank, r.id) for r in out) == want
    # above the window-group-limit threshold positions come from range slices
    confs = {"spark.sql.optimizer.windowGroupLimitThreshold": "1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}   # keep several slices
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        out = B.top_hits(df, ["g"], 3, [F.col("v").desc(), F.col("id").asc()]).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((r.g, r.rank, r.id) for r in out) == want


def test_missing_global_and_query_aggs(flowers):
    req = query(P.term("species", "setosa")) + aggs(all=B.global_(metrics={"n": M.value_count("id")}),
                                                    m=B.missing("maybe"))
    res = execute(flowers, req)
    assert res["all"].first().n == 12
    assert res["m"].first().doc_count == 0  # id 0 (the null) is virginica


def test_nested_terms(spark):
    child = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b")], "pid int, sku string")
    out = B.nested_terms("sku", "pid").run(child).collect()
    assert [(r.key, r.doc_count, r.parent_count) for r in out] == [("a", 3, 2), ("b", 1, 1)]


def test_bucket_series(spark):
    bt = spark.createDataFrame([(1, 10.0), (2, 30.0), (3, 20.0), (4, 60.0)], "key int, v double")
    r = S.cumulative_sum(bt, "v", "c").orderBy("key").collect()
    assert [x.c for x in r] == [10.0, 40.0, 60.0, 120.0]
    r = S.derivative(bt, "v", "d").orderBy("key").collect()
    assert [x.d for x in r] == [None, 20.0, -10.0, 40.0]
    r = S.serial_diff(bt, "v", "d", lag=2).orderBy("key").collect()
    assert [x.d for x in r] == [None, None, 10.0, 30.0]
    r = S.moving_fn(bt, "v", "m", window=2).orderBy("key").collect()
    assert [x.m for x in r] == [None, 10.0, 20.0, 25.0]
    r = S.bucket_sort(bt, [F.col("v").desc(), F.col("key")], from_=1, size=2).collect()
    assert sorted(x.key for x in r) == [2, 3]
    assert [x.key for x in S.bucket_selector(bt, "v > 15").collect()] == [2, 3, 4]
    row = S.siblings(bt, "v", "s").first()
    assert row.s_max == 60.0 and row.s_max_key == 4 and row.s_min_key == 1 and row.s_p50 == 25.0
    assert S.sibling(bt, "v", "a", "avg").first().a == 30.0


def test_calendar_buckets_and_gap_fill(spark):
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 3, 10),), (dt.datetime(2024, 5, 20),), (dt.datetime(1969, 12, 31),)],
                               "t timestamp_ntz")
    week = [r.key for r in B.date_histogram("t", calendar_interval="week").run(ts).collect()]
    assert week == [dt.datetime(1969, 12, 29), dt.datetime(2024, 1, 1), dt.datetime(2024, 5, 20)]
    q = [r.key for r in B.date_histogram("t", calendar_interval="quarter").run(ts).collect()]
    assert q == [dt.datetime(1969, 10, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 4, 1)]
    recent = ts.filter(F.year("t") == 2024)
    months = B.date_histogram("t", calendar_interval="month", min_doc_count=0).run(recent).collect()
    assert [(r.key.month, r.doc_count) for r in months] == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 1)]
    years = [r.key for r in B.date_histogram("t", calendar_interval="year").run(ts).collect()]
    assert years == [dt.datetime(1969, 1, 1), dt.datetime(2024, 1, 1)]


def test_nested_array_terms_equal_child_table(spark):
    # the same buckets whether the elements are an array of structs in the
    # parent or rows of their own table; parent_count counts distinct parents
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    child = li.select(F.col("l_orderkey").alias("oid"), F.col("l_returnflag").alias("flag"))
    parents = child.groupBy("oid").agg(F.collect_list(F.struct("flag")).alias("items"))
    a = {(r.key, r.doc_count, r.parent_count) for r in B.nested_terms("flag", "oid").run(child).collect()}
    b = {(r.key, r.doc_count, r.parent_count)
         for r in B.nested_array_terms(parents, "items", "flag", "oid").collect()}
    want = {(r.flag, r.n, r.p) for r in child.groupBy("flag").agg(F.count("*").alias("n"),
                                                                  F.countDistinct("oid").alias("p")).collect()}
    assert a == b == want


def test_levels_are_made_of_one_scan(spark):
    rows = [(i, f"a{i % 3}" if i % 7 else None, None if i % 5 == 0 else i % 4, float(i) if i % 6 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, a string, b int, v double")
    spec = lambda extra: B.tree([
        ("a", B.terms("a", metrics={"m": M.avg("v"), "n": M.value_count("v")})),
        ("b", B.histogram("b", 2, metrics={"s": M.stats("v"), **extra}), 1)])
    assert spec({})._rolled_up(df) is not None and spec({"p": M.percentiles("v", [50])})._rolled_up(df) is None
    one = {(r.a, r.b): r for r in spec({}).run(df).collect()}
    many = {(r.a, r.b): r for r in spec({"p": M.percentiles("v", [50])}).run(df).drop("b_p_p50").collect()}
    assert one.keys() == many.keys() and len(one) == 3
    for k, r in one.items():
        for c in r.asDict():
            assert r[c] == many[k][c] or abs(r[c] - many[k][c]) < 1e-9, (k, c)
    # rows without a bucket of the lower level count in the upper one
    assert {r.a: r.a_doc_count for r in one.values()} == {f"a{j}": sum(1 for x in rows if x[1] == f"a{j}") for j in range(3)}
    assert spec({}).run(df.limit(0)).count() == 0


def test_levels_with_several_values_count_documents_once(spark):
    df = spark.createDataFrame([(1, ["x", "y"], 3), (2, ["x"], 4), (3, [], 5)], "id int, tags array<string>, v int")
    spec = B.tree([("tag", B.terms("tags", metrics={"s": M.sum_("v")})), ("v", B.terms("v"))])
    assert spec._rolled_up(df) is None
    got = {(r.tag, r.v): (r.tag_doc_count, r.tag_s, r.v_doc_count) for r in spec.run(df).collect()}
    assert got == {("x", 3): (2, 7, 1), ("x", 4): (2, 7, 1), ("y", 3): (1, 3, 1)}


def test_best_rows_of_a_hot_bucket(spark):
    df = spark.range(3000).selectExpr("id", "if(id % 10 = 0, 'cold', 'hot') AS k", "if(id % 4 = 0, NULL, id % 100) AS v")
    spec = B.terms("k", metrics={"best": M.top_hits(3, [("v", "desc"), ("id", "asc")], ["id"]), "n": M.value_count("v")})
    got = {r.key: [x.id for x in r.best] for r in spec.run(df).collect()}
    rows = [(i, "cold" if i % 10 == 0 else "hot", None if i % 4 == 0 else i % 100) for i in range(3000)]
    want = {k: [i for i, _, _ in sorted((r for r in rows if r[1] == k), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))[:3]] for k in ("hot", "cold")}
    assert got == want
    whole = B.terms("k", metrics={"best": M.top_hits(1, [("v", "asc"), ("id", "asc")])}).run(df).first().best
    assert len(whole) == 1 and set(whole[0].asDict()) == {"id", "k", "v"}
    top = M.aggregate(df, [], {"best": M.top_hits(2, [("id", "desc")], ["id"])}, doc_count=None).first().best
    assert [x.id for x in top] == [2999, 2998]


def test_parents_count_once_in_a_bucket(spark):
    child = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, "a"), (9, "c"), (3, None)], "pid int, k string")
    parents = spark.createDataFrame([(1, 10.0), (2, 5.0), (2, 5.0), (4, 99.0)], "pid int, v double")
    spec = B.nested_terms("k", "pid", metrics={"n": M.value_count("pid")}, parent_metrics={"s": M.sum_("v"), "m": M.avg("v")}, parents=parents)
    got = {r.key: (r.doc_count, r.parent_count, r.s, r.m, r.n) for r in spec.run(child).collect()}
    assert got == {"a": (4, 2, 15.0, 7.5, 3), "b": (1, 1, 10.0, 10.0, 1), "c": (1, 1, None, None, 1)}
    inside = child.where("pid is not null").join(parents.dropDuplicates(), "pid", "left")
    got = {r.key: r.s for r in B.nested_terms("k", "pid", parent_metrics={"s": M.sum_("v")}).run(inside).collect()}
    assert got == {"a": 15.0, "b": 10.0, "c": None}


def test_masks_equal_pairs_of_conditions(spark):
    df = spark.range(400).selectExpr("id", "if(id % 11 = 0, NULL, id % 30) AS v")
    named = {f"f{i}": (lambda p, i=i: p.range_("v", gte=i, lt=i + 7)) for i in range(25)}
    got = {r.key: r.doc_count for r in B.adjacency_matrix(named).run(df).collect()}
    want = {}
    for i in range(400):
        v = None if i % 11 == 0 else i % 30
        hit = sorted(n for n, k in ((f"f{j}", j) for j in range(25)) if v is not None and k <= v < k + 7)
        for a in range(len(hit)):
            want[hit[a]] = want.get(hit[a], 0) + 1
            for b in hit[a + 1:]:
                want[f"{hit[a]}&{b}"] = want.get(f"{hit[a]}&{b}", 0) + 1
    assert got == want
    plan = B.adjacency_matrix(named).run(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Aggregate")  # masks are counted before they are turned into pairs


def test_rows_dealt_by_parent(spark, monkeypatch):
    """As many tasks as the rows ask for, whatever AQE would merge; the semi join and the buckets shuffle the rows no more."""
    monkeypatch.setattr(B, "ROWS_BY_PARENT", 100)
    for n in (90, 900):
        child = spark.range(n).selectExpr("id % 70 AS pid", "concat('k', id % 3) AS k", "id AS q")
        parents = spark.range(60).selectExpr("id AS pid", "id * 2 AS v")
        dealt, own = B.by_parent(child, parents.union(parents.limit(3)), "pid")
        assert own.rdd.getNumPartitions() == -(-(n + 63) // 100)
        spec = B.nested_terms("k", "pid", metrics={"q": M.avg("q")}, parent_metrics={"s": M.sum_("v"), "top": M.max_("v")}, parents=parents)
        want = spec.run(child.join(parents.select("pid"), "pid", "left_semi")).collect()
        assert spec.run(dealt).collect() == want and replace(spec, parents=own).run(dealt).collect() == want
        assert max(r.n for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) <= 400
    assert [df.count() for df in B.by_parent(spark.range(0), spark.range(0), "id")] == [0, 0]


def test_reverse_nested_metrics_deal_lines_by_order(spark, tmp_path, monkeypatch):
    from docsift.plans.registry_hard import b_reverse_nested_metrics

    monkeypatch.setattr(B, "ROWS_BY_PARENT", 50)
    spark.range(300).selectExpr("id DIV 4 AS l_orderkey", "element_at(array('A', 'N', 'R'), CAST(id % 3 AS INT) + 1) AS l_returnflag",
                                "CAST(id % 50 AS DOUBLE) AS l_quantity").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(60).selectExpr("id AS o_orderkey", "CAST(id AS DOUBLE) AS o_totalprice").write.parquet(str(tmp_path / "orders.parquet"))
    out = b_reverse_nested_metrics(spark, str(tmp_path))
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert ", 8), REPARTITION_BY_NUM" in plan
    assert {(r.key, r.doc_count, r.parent_count, r.total, r.top) for r in out.collect()} == {
        (f, len(e), len(set(e)), float(sum(set(e))), float(max(e))) for f, e in
        (("ANR"[j], [i // 4 for i in range(240) if i % 3 == j]) for j in range(3))}
