"""Refusals and odd inputs that no registered query can show."""

import json
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from docsift.functions import predicates as P
from docsift.operators import buckets as B
from docsift.operators import write as W
from docsift.operators.ordered import top_n_per_group
from docsift.plans.search import Resource, execute, query, select_fields, sort_on
from docsift.session import checkpoint_dir
from docsift.sources import documents as D


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "c", 3.0)], "id long, name string, v double")


def test_bad_actions_fail(spark, base):
    for row in ((1, 1, "purge", "x"), (1, None, "delete", "x"), (None, 1, "index", "x"), (1, 1, None, "x")):
        feed = spark.createDataFrame([row], "id long, seq int, action string, name string")
        with pytest.raises(Exception, match="bad action"):
            W.apply_actions(base, feed, "id").collect()


def test_actions_keep_other_fields(spark, base):
    feed = spark.createDataFrame([(1, 1, "update", "z", 9), (2, 1, "index", "y", None), (7, 1, "create", "n", 5)],
                                 "id long, seq int, action string, name string, rank int")
    got = {r.id: (r.name, r.v, r.rank) for r in W.apply_actions(base, feed, "id").collect()}
    assert got == {1: ("z", 1.0, 9), 2: ("y", None, None), 7: ("n", None, 5), None: ("c", 3.0, None)}


def test_ids_of_each_row(spark, base):
    new = spark.createDataFrame([(None, "x"), (None, "x"), (1, "q")], "id long, name string")
    got = W.upsert(base, new, "id").collect()
    assert len(got) == 5 and len({r.id for r in got if r.id is not None}) == 4
    assert {r.name for r in got if r.id == 1} == {"q"}
    same = W.assign_ids(spark.createDataFrame([("x",)] * 20, "name string"), "id")
    assert same.select("id").distinct().count() == 20
    assert {r.id for r in same.collect()} == {r.id for r in same.collect()}  # fixed by the checkpoint


def test_conflicting_kinds_are_refused(spark, base):
    text = spark.createDataFrame([(1, "n", "one")], "id long, name string, v string")
    with pytest.raises(TypeError, match="v: double and string"):
        W.upsert(base, text, "id")
    with pytest.raises(TypeError, match="v: double and string"):
        D.union_pages([base, text])
    wide = spark.createDataFrame([(5, 1)], "id int, v int")
    assert D.union_pages([base, wide]).count() == 4 and W.upsert(base, wide, "id").count() == 4


def test_text_ids_and_bad_ids(spark, base):
    assert {r.id for r in W.delete_ids(base, ["1", 2]).collect()} == {None}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        W.delete_ids(base, ["x1"]).collect()


def test_replies(spark, tmp_path):
    good = {"hits": {"hits": [{"_id": "1", "_source": {"v": 1}}, {"_id": "2", "_source": {"v": 2}}]}}
    table = lambda *texts: D.hits_to_table(spark.createDataFrame([(t,) for t in texts], "reply string"), "reply", "v long")
    assert table(json.dumps(good), json.dumps({"hits": {"hits": []}}), None).count() == 2
    with pytest.raises(Exception, match="malformed reply"):
        table(json.dumps(good)[:-20]).collect()
    with pytest.raises(Exception, match="reply without hits"):
        table(json.dumps({"error": {"type": "x"}})).collect()
    (tmp_path / "r.json").write_text(json.dumps(good, indent=2))
    assert D.read_search_replies(spark, str(tmp_path), "v long", whole_files=True).count() == 2


def test_json_conflicts_are_named(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 1.25, "b": 2}',), ('{"a": null, "b": 3}',)], "doc string")
    fields = D.infer_json_fields(df, "doc")
    got = {r.field: r.n_types for r in fields.collect()}
    assert got == {"a": 1, "b": 2}
    with pytest.raises(TypeError, match="1 fields .* b"):
        D.require_consistent_types(fields)


def test_top_n_of_a_hot_group(spark):
    df = spark.range(0, 40_000, 1, 40).select(F.col("id"), F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id") % 3).alias("g"))
    for n, skip in ((5, 0), (3, 4), (1500, 0)):
        got = defaultdict(list)
        for r in top_n_per_group(df, ["g"], [F.col("id").desc()], n, skip, rank="r").collect():
            got[r.g].append((r.r, r.id))
        want = defaultdict(list)
        for r in sorted(df.collect(), key=lambda r: -r.id):
            want[r.g].append(r.id)
        assert {g: sorted(v) for g, v in got.items()} == {
            g: [(i + 1, x) for i, x in enumerate(v)][skip: skip + n] for g, v in want.items() if v[skip: skip + n]}


def test_any_element_matches(spark):
    df = spark.createDataFrame(
        [(1, ["red", "Blue"], [1, 5]), (2, [], None), (3, None, [9]), (4, ["redder", None], [None])], "id int, tags array<string>, n array<int>")
    p = P.on(df)
    ids = lambda c: sorted(r.id for r in df.filter(c).collect())
    assert ids(p.term("tags", "red")) == [1] and ids(p.term("tags", "blue", case_insensitive=True)) == [1]
    assert ids(p.terms("n", [5, 9])) == [1, 3] and ids(p.range_("n", gt=1, lt=5)) == []
    assert ids(p.prefix("tags", "red")) == [1, 4] and ids(p.wildcard("tags", "r?d")) == [1]
    assert ids(p.regexp("tags", "re.*r")) == [4] and ids(p.fuzzy("tags", "bleu")) == [1]
    assert ids(p.match("tags", "BLUE")) == [1] and ids(p.match_phrase("tags", "redder")) == [4]
    assert ids(p.exists("tags")) == [1, 4] and ids(p.missing("tags")) == [2, 3] and ids(p.missing("n")) == [2, 4]
    assert ids(p.not_(p.term("tags", "red"))) == [2, 3, 4]
    assert ids(p.multi_match(["tags", "tags"], "redder")) == [4] and ids(p.term("id", 3)) == [3]
    got = {r.key: r.doc_count for r in B.terms("tags", missing="none").run(df).collect()}
    assert got == {"red": 1, "Blue": 1, "redder": 1, "none": 3}


def test_paths_through_arrays_of_objects(spark):
    df = spark.createDataFrame([(1, [([("x", 1)],), ([("y", 2)],)]), (2, None)], "id int, a array<struct<b:array<struct<c:string,d:int>>>>")
    p = P.on(df)
    assert [r.id for r in df.filter(p.term("a.b.c", "y")).collect()] == [1]
    out = execute(df, query() + select_fields(["a.b.c"])).collect()
    assert out[0].a[1].b[0].asDict() == {"c": "y"} and out[1].a is None


def test_array_sort_takes_the_deciding_element(spark):
    df = spark.createDataFrame([(1, [2]), (2, [3, 1]), (3, [])], "id int, n array<int>")
    order = lambda *k: [r.id for r in execute(df, query(size=9) + sort_on(k)).collect()]
    assert order("n", "asc") == [2, 1, 3] and order("n", "desc") == [2, 1, 3] and order("n", "asc", "last", "max") == [1, 2, 3]


def test_delete_of_type_leaves_other_types(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id int, kind string")
    assert [r.kind for r in Resource(spark, df, "a", "kind").delete(ids=[1]).collect()] == ["b"]


def test_bucketed_version_has_one_file_per_bucket(spark):
    table = W.save_bucketed_version(spark.range(0, 1000, 1, 6).withColumnRenamed("id", "k"), "bk_files", "1", "k", 8)
    files = {f for f in spark.table(table).inputFiles()}
    assert 0 < len(files) <= 8
    spark.sql("DROP VIEW bk_files")
    spark.sql(f"DROP TABLE {table}")


def test_checkpoint_folder_is_needed_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_sample_by_score_needs_its_size(spark):
    with pytest.raises(ValueError, match="shard_size"):
        B.sampler(B.terms("x"), score="y").sample(spark.range(1))


def test_relevance_ranks_more_rows_than_any_size(spark, tmp_path):
    from docsift.functions import predicates as P
    from docsift.plans.registry import QUERIES
    from docsift.plans.search import execute, query
    docs = spark.range(20_060).select(F.col("id").alias("doc_id"), F.concat(F.lit("esat x"), F.when(F.col("id") % 9 == 0, " esat").otherwise("")).alias("text"),
                                      F.when(F.col("id") < 20_050, "en").otherwise("de").alias("lang"), F.lit(1).alias("n_chars"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [r.doc_id for r in execute(docs, query(P.term("lang", "en"), rank=("text", "esat", "doc_id"))).collect()]
    assert got == sorted(range(20_050), key=lambda i: (i % 9 != 0, i))
    first = QUERIES["relevance_repeated_ids"](spark, str(tmp_path)).collect()
    want = sorted(((i % 9 != 0, i % 3 == 0, i % 7) for i in range(20_050)))[:200]
    assert [r.place for r in sorted(first, key=lambda r: r.place)] == list(range(1, 201))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in first) == sorted((n, 0 if n else d) for _, n, d in want)


def test_upsert_refuses_ids_that_the_table_repeats(spark):
    from docsift.operators import write as W
    base = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "id long, v string")
    new = spark.createDataFrame([(2, "n"), (3, "m")], "id long, v string")
    got = sorted(((r.id, r.v) for r in W.upsert(base, new).collect()), key=str)
    assert got == sorted([(1, "a"), (1, "b"), (2, "n"), (None, "d"), (None, "e"), (3, "m")], key=str)
    with pytest.raises(Exception, match="more than once: 1"):
        W.upsert(base, spark.createDataFrame([(1, "n")], "id long, v string")).collect()


def test_pages_that_conflict_pairwise(spark):
    from docsift.sources.documents import union_pages
    one = spark.createDataFrame([(1,)], "id long")
    two, three = one.withColumn("x", F.lit(7)), one.withColumn("x", F.lit("7"))
    with pytest.raises(TypeError, match="x: int and string"):
        union_pages([one, two, three])
    assert union_pages([one, one.withColumn("x", F.lit(None)), three]).schema["x"].dataType.simpleString() == "string"


def test_included_objects_lose_their_excluded_parts(spark):
    from docsift.plans.search import execute, query, select_fields
    df = spark.sql("SELECT 1 AS id, named_struct('a', 1, 'b', 2) AS o, array(named_struct('a', 1, 'b', 2)) AS items")
    pick = lambda inc, exc=(): execute(df, query() + select_fields(inc, exc)).schema.simpleString()
    assert pick(["*"], ["items.a"]) == "struct<id:int,o:struct<a:int,b:int>,items:array<struct<b:int>>>"
    assert pick(["items", "o"], ["o.b"]) == "struct<o:struct<a:int>,items:array<struct<a:int,b:int>>>"
    assert pick(["items.*"], ["items.b"]) == "struct<items:array<struct<a:int>>>"
    assert pick(["*"], ["items.*"]) == "struct<id:int,o:struct<a:int,b:int>>"


def test_several_results_are_planned_when_read(spark):
    from docsift.operators import buckets as B
    from docsift.plans.search import aggs, execute
    df = spark.range(100).selectExpr("id % 3 AS a", "id % 5 AS b", "id % 7 AS c")
    got = execute(df, aggs(a=B.terms("a"), b=B.terms("b"), c=B.terms("c")))
    assert list(got) == ["a", "b", "c"] and len(got) == 3 and "c" in got
    assert "Expand" not in got["a"]._jdf.queryExecution().toString()
    assert {n: got[n].count() for n in got} == {"a": 3, "b": 5, "c": 7}
    with pytest.raises(KeyError):
        got["d"]


def test_documents_are_rows_or_set_aside(spark):
    from docsift.sources.documents import typed_documents
    texts = [None, "", "{", "3", "[1]", "null", '{"a":1,"b":{"x":1}}', '{"a":2.5,"b":{"x":2,"y":"z"}}', '{"a":"t"}', '{"a":null,"c":[1,2]}', '{"b":7,"c":["u"]}', "{}"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, doc string")
    got = typed_documents(df, "doc", ["n"])
    why = {r.n: r.reason for r in got.rejected.collect()}
    assert why == {0: "no document", 1: "malformed", 2: "malformed", 3: "not an object", 4: "not an object", 5: "not an object",
                   8: "conflict: a is string, elsewhere number", 10: "conflict: b is number, elsewhere object"}
    rows = {r.n: (float(r.a) if r.a is not None else None, r.b and r.b.x) for r in got.rows.collect()}
    assert rows == {6: (1.0, 1), 7: (2.5, 2), 9: (None, None), 11: (None, None)} and list(got.types) == ["a", "b", "c"]
    assert [r.document for r in got.rejected.where("n = 2").collect()] == ["{"]
    none = typed_documents(df.limit(0), "doc")
    assert none.rows.count() == none.rejected.count() == 0 and none.types == {}
    with pytest.raises(ValueError, match="case"):
        typed_documents(spark.createDataFrame([('{"a":1,"A":2}',)], "doc string"), "doc")


@pytest.mark.parametrize("text", ['{"k":', '{"k":"x"}', "[1]", "7", '[{"k":1}]'])
def test_a_table_of_json_refuses_what_it_cannot_read(spark, text):
    from docsift.sources.documents import json_table
    df = spark.createDataFrame([('{"k":1}',), (text,), (None,)], "doc string")
    with pytest.raises(Exception, match="malformed document"):
        json_table(df, "doc", "k int").collect()
    assert [r.k for r in json_table(df, "doc", "k int", malformed="null").collect()][0] == 1
    assert [r.k for r in json_table(df.where("doc IS NULL OR doc = '{\"k\":1}'"), "doc", "k int").collect()] == [1, None]
