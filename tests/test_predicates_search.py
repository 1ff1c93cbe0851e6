import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from docsift.functions import predicates as P
from docsift.plans.search import aggs, execute, query, resolve_fields, select_fields, sort_on
from docsift.operators import metrics as M


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "Alice Smith", "a-1", 30, ["x", "y"]),
            (2, "bob jones", "b_2", None, ["z"]),
            (3, None, "c%3", 45, None),
            (4, "Alicia Keys", "a-4", 22, [])]
    return spark.createDataFrame(rows, "id long, name string, code string, age int, tags array<string>")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_negation_is_null_safe(people):
    # SQL NOT drops the NULL-age row; document semantics keep it
    assert ids(people.filter(~(F.col("age") > 25))) == [4]
    assert ids(people.filter(P.not_(P.range_("age", gt=25)))) == [2, 4]


def test_term_terms_range_exists(people):
    assert ids(people.filter(P.term("code", "a-1"))) == [1]
    assert ids(people.filter(P.terms("code", ["a-1", "a-4", "zz"]))) == [1, 4]
    assert ids(people.filter(P.range_("age", gte=22, lt=45))) == [1, 4]
    assert ids(people.filter(P.exists("name"))) == [1, 2, 4]
    assert ids(people.filter(P.missing("age"))) == [2]
    assert ids(people.filter(P.term("name", "BOB JONES", case_insensitive=True))) == [2]


def test_prefix_wildcard_regexp_fuzzy(people):
    assert ids(people.filter(P.prefix("name", "Ali"))) == [1, 4]
    assert ids(people.filter(P.prefix("name", "ali", case_insensitive=True))) == [1, 4]
    # % and _ are literal in wildcard patterns
    assert ids(people.filter(P.wildcard("code", "c%?"))) == [3]
    assert ids(people.filter(P.wildcard("code", "?_2"))) == [2]
    assert ids(people.filter(P.wildcard("code", "a*"))) == [1, 4]
    # regexp must match the whole value
    assert ids(people.filter(P.regexp("code", "a-[0-9]"))) == [1, 4]
    assert ids(people.filter(P.regexp("code", "a"))) == []
    assert ids(people.filter(P.fuzzy("name", "alise smith", 2))) == [1]


def test_match_operators(people):
    assert ids(people.filter(P.match("name", "alice keys"))) == [1, 4]
    assert ids(people.filter(P.match("name", "alicia keys", operator="and"))) == [4]
    assert ids(people.filter(P.match("name", "alice smith jones", minimum_should_match=2))) == [1]
    assert ids(people.filter(P.match_phrase("name", "Smith"))) == [1]
    assert ids(people.filter(P.match_phrase("name", "jones bob"))) == []
    assert ids(people.filter(P.match_phrase("name", "bob  JONES"))) == [2]
    assert ids(people.filter(P.multi_match(["name", "code"], "b 4"))) == [2, 4]
    assert ids(people.filter(P.any_field(people, "c"))) == [3]


def test_bool_should(people):
    should = [P.term("code", "a-1"), P.term("code", "b_2")]
    assert ids(people.filter(P.bool_(should=should))) == [1, 2]
    # with a must clause, should is optional unless minimum_should_match is set
    assert ids(people.filter(P.bool_(must=[P.exists("name")], should=should))) == [1, 2, 4]
    assert ids(people.filter(P.bool_(must=[P.exists("name")], should=should, minimum_should_match=1))) == [1, 2]
    assert ids(people.filter(P.bool_(must_not=[P.range_("age", gt=25)]))) == [2, 4]


def test_nested_exists_and_flat(spark):
    orders = spark.createDataFrame(
        [(1, [Row(sku="a", qty=5), Row(sku="b", qty=1)]), (2, [Row(sku="a", qty=1)]), (3, None)],
        "oid long, items array<struct<sku:string, qty:int>>")
    # both conditions must hold on the SAME element
    pred = P.nested("items", lambda e: (e["sku"] == "a") & (e["qty"] > 2))
    assert [r.oid for r in orders.filter(pred).collect()] == [1]
    child = spark.createDataFrame([(1, "a", 5), (1, "b", 1), (2, "a", 1)], "oid long, sku string, qty int")
    flat = P.nested_flat(orders, child, "oid", "oid", (F.col("sku") == "a") & (F.col("qty") > 2))
    assert [r.oid for r in flat.collect()] == [1]


def test_array_of_values_matches_any_element(people):
    assert ids(people.filter(P.nested("tags", lambda x: x == "z"))) == [2]
    # empty and missing arrays never match, so their negation keeps them
    assert ids(people.filter(P.not_(P.nested("tags", lambda x: x.isin("x", "z"))))) == [3, 4]


def test_terms_lookup(spark, people):
    lookup = spark.createDataFrame([("a-4",), ("zz",), (None,)], "c string")
    assert ids(P.terms_lookup(people, "code", lookup, "c")) == [4]


def test_composition_rules(people):
    q = query(P.exists("name"), size=2)
    s = sort_on(("age", "desc"))
    f = select_fields(["id"])
    a = aggs(n=M.value_count("id"))
    assert (q + s).kind == "query" and (s + q).sort == (q + s).sort
    assert (f + s).kind == "partial"
    assert (q + (f + s)).kind == "query"
    assert (q + a).kind == "aggs"
    for bad in [(a, s), (a, f), (s, s), (f, f), (a, a), (q, q)]:
        with pytest.raises((TypeError, ValueError)):
            bad[0] + bad[1]
    with pytest.raises(ValueError):
        execute(people, f + s)
    with pytest.raises(TypeError):
        execute(people, s)


def test_search_sort_size_fields(people):
    out = execute(people, query(size=2) + sort_on(("age", "desc", "last"), "id") + select_fields(["id"]))
    assert [r.id for r in out.collect()] == [3, 1]
    out = execute(people, query(size=2) + sort_on(("age", "asc", "first"), "id"))
    assert [r.id for r in out.collect()] == [2, 4]
    assert execute(people, query(size=0)).count() == 0
    assert execute(people, query()).count() == 4
    # array sort modes
    out = execute(people, query() + sort_on(("tags", "desc", "last", "max"), "id"))
    assert [r.id for r in out.collect()][:2] == [2, 1]


def test_field_patterns(spark):
    df = spark.createDataFrame([(1, Row(b=2, c=Row(d="x", e="y")), "t")],
                               "id int, a struct<b:int, c:struct<d:string, e:string>>, tag string")
    names = lambda cols: df.select(*cols).columns
    assert names(resolve_fields(df.schema, ["a.*"])) == ["a"]
    assert names(resolve_fields(df.schema, ["*"], ["a"])) == ["id", "tag"]
    sub = df.select(*resolve_fields(df.schema, ["a.c.d", "id"]))
    assert sub.schema.simpleString() == "struct<id:int,a:struct<c:struct<d:string>>>"
    sub = df.select(*resolve_fields(df.schema, ["*"], ["a.c.e"]))
    assert sub.first()["a"]["c"].asDict() == {"d": "x"}


def test_resource_maintenance_verbs(spark):
    import tempfile

    from pyspark.sql import types as T

    from docsift.plans.search import Resource

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("_type", T.StringType()),
                           T.StructField("name", T.StringType())])
    res = Resource(spark, "docsift_res_verbs", doc_type="a")
    res.create(schema)
    with pytest.raises(Exception):
        res.create(schema)                                   # exists already
    assert "docsift_res_verbs" in {r.name for r in res.list_tables().collect()}
    new = spark.createDataFrame([(1, "x"), (2, "y")], "ID long, Name string")
    state = res.index(new)
    assert sorted((r.id, r._type, r.name) for r in state.collect()) == [(1, "a", "x"), (2, "a", "y")]
    path = Resource.save(state, tempfile.mkdtemp(prefix="docsift-res-"), "1")
    v1 = Resource(spark, path, doc_type="a")
    assert sorted(r.id for r in v1.delete(ids=[1]).collect()) == [2]
    with pytest.raises(PermissionError):
        v1.delete()
    assert v1.delete(approve=True).count() == 0              # all documents of type "a"
    assert v1.delete(approve=True).columns == ["id", "_type", "name"]
    assert res.delete(approve=True) is not None              # typed: removes the type only
    Resource(spark, "docsift_res_verbs").delete(approve=True)
    assert "docsift_res_verbs" not in {r.name for r in res.list_tables().collect()}


def test_small_public_helpers(spark):
    from docsift.functions import mapping as MP
    from docsift.operators import buckets as B

    df = spark.createDataFrame([(1, "a.b", "2024-01-02"), (2, "ab", "1700000000000"), (3, None, "bad")],
                               "id int, s string, t string")
    assert df.filter(P.match_none()).count() == 0
    assert [r.id for r in df.filter(P.regexp("s", P.escape_regex("a.b"))).collect()] == [1]
    ts = MP.map_timestamps(df, ["t"]).orderBy("id").collect()
    assert str(ts[0].t) == "2024-01-02 00:00:00" and ts[1].t is not None and ts[2].t is None
    one = B.filter_(F.col("id") >= 2, {"m": M.max_("id")}).run(df).collect()
    assert [(r.doc_count, r.m) for r in one] == [(2, 3)]


def test_unsized_sort_splits_a_hot_sort_value(spark):
    # one sort value holds most rows: the row-hash tie-breaker lets the range
    # partitioning of the global sort split them over several tasks
    rows = [("hot" if i % 4 else f"k{i}", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "s string, i int")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        out = execute(df, query() + sort_on("s"))
        parts = out.withColumn("p", F.spark_partition_id()).filter(F.col("s") == "hot").select("p").distinct()
        assert parts.count() > 1
        got = [r.s for r in out.collect()]
        assert got == sorted(got) and len(got) == 4000
    finally:
        spark.conf.set(key, old)
