"""Tables that change by buckets, and reading them page by page."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from docsift.operators import write as W
from docsift.operators.versioned import BucketedTable, StaleVersion
from docsift.plans.paging import read_page
from docsift.plans.search import execute, query, select_fields, sort_on


@pytest.fixture
def people(spark, tmp_path):
    rows = [(i, f"n{i}", i % 7 if i % 5 else None) for i in range(500)]
    return BucketedTable.create(spark.createDataFrame(rows, "id long, name string, k int"), str(tmp_path / "people"), buckets=16)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(table):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{table.path}/data") for f in names if f.endswith(".parquet")}


def test_an_upsert_writes_its_buckets_only(spark, people):
    before, old = files(people), rows_of(people.df)
    new = spark.createDataFrame([(3, "new", 1), (3, "newer", 2), (9999, "added", 3)], "id int, name string, seq int")
    later = people.upsert(new, "seq")
    touched = people._touched(spark.createDataFrame([(3,), (9999,)], "id long"))
    assert 1 <= len(touched) <= 2 and len(files(later)) - len(before) == len(touched) and before < files(later)
    assert {b: f for b, f in later.folders.items() if b not in touched} == {b: f for b, f in people.folders.items() if b not in touched}
    assert rows_of(later.df) == rows_of(W.upsert(people.df, new, "id", "seq"))
    assert rows_of(people.df) == old and rows_of(later.at(0).df) == old
    assert [r.name for r in later.get([3, 9999, 12345]).orderBy("id").collect()] == ["newer", "added"]
    # only the touched buckets' files are opened
    read = later.get([3])._jdf.inputFiles()
    assert all(f"_bucket={b}/" in f for f in read for b in people._touched(spark.createDataFrame([(3,)], "id long")))


def test_changes_equal_those_of_the_whole_table(spark, people):
    rng = random.Random(1)
    table, now = people, people.df
    for step in range(3):
        feed = spark.createDataFrame(
            [(rng.randrange(0, 700), i, rng.choice(["index", "create", "update", "delete"]), f"s{step}i{i}", rng.choice([None, i])) for i in range(60)],
            "id long, seq int, action string, name string, k int")
        table, now = table.apply(feed), W.apply_actions(now, feed, "id")
        assert rows_of(table.df) == rows_of(now)
    table, now = table.delete([1, 2, 3, 10_000]), W.delete_ids(now, [1, 2, 3, 10_000])
    assert rows_of(table.df) == rows_of(now) and table.versions() == list(range(5))
    assert rows_of(BucketedTable.open(spark, people.path).df) == rows_of(now)


def test_a_new_field_and_rows_without_ids(spark, people):
    later = people.upsert(spark.createDataFrame([(None, "x", 1.5), (None, "y", None), (7, "z", 2.5)], "id long, name string, Score double"))
    assert later.schema.names == ["id", "name", "k", "score"] and later.df.count() == 502
    assert rows_of(later.df.where("score is not null").select("name", "score")) == [("x", 1.5), ("z", 2.5)]
    assert later.upsert(spark.createDataFrame([("w",)], "name string")).df.where("name = 'w' and id < 0").count() == 1


def test_a_stale_state_is_refused(spark, people):
    new = spark.createDataFrame([(1, "a", 1)], "id long, name string, k int")
    later = people.upsert(new)
    with pytest.raises(StaleVersion):
        people.delete([2])
    with pytest.raises(StaleVersion):
        people._name(1, "{}")  # two writers that both saw version 0 as the latest
    assert rows_of(BucketedTable.open(spark, people.path).df) == rows_of(later.df)
    with pytest.raises(FileExistsError):
        BucketedTable.create(new, people.path)
    with pytest.raises(FileNotFoundError):
        people.at(17)


@pytest.mark.parametrize("rows", [[(1, "a"), (1, "b")], [(None, "a")]])
def test_repeated_or_missing_ids_are_refused(spark, tmp_path, rows):
    with pytest.raises(Exception, match="unique"):
        BucketedTable.create(spark.createDataFrame(rows, "id long, name string"), str(tmp_path / "t"))
    assert not os.path.exists(tmp_path / "t" / "versions")


def test_empty_tables(spark, tmp_path):
    empty = BucketedTable.create(spark.createDataFrame([], "id string, v int"), str(tmp_path / "e"), buckets=4)
    assert empty.df.count() == 0 and empty.delete(["a"]).df.count() == 0
    one = BucketedTable.open(spark, empty.path).upsert(spark.createDataFrame([("a", 1)], "id string, v int"))
    none = one.delete(["a"])
    assert rows_of(one.df) == [("a", 1)] and none.df.count() == 0 and none.folders == {}
    same = none.upsert(one.df.limit(0))
    assert same.version == none.version


SORTS = [sort_on("k"), sort_on(("k", "desc")), sort_on(("k", "asc", "first")), sort_on(("k", "desc", "first"), "name"), sort_on(("name", "desc"), "k")]


@pytest.mark.parametrize("size", [1, 7, 20, 50, 400])
def test_pages_joined_equal_one_sorted_read(spark, tmp_path, size):
    n = 20 if size == 1 else 50
    rows = [(i, None if i % 4 == 0 else f"n{i % 6}", None if i % 3 == 0 else float("nan") if i % 11 == 0 else i % 5 / 7) for i in range(n)]
    table = BucketedTable.create(spark.createDataFrame(rows, "id long, name string, k double"), str(tmp_path / "t"), buckets=4)
    for sort in SORTS[: 2 if size == 1 else None]:
        req = query(F.col("id") != 5) + (sort + select_fields(["id", "name", "k"]))
        want = [str(tuple(r)) for r in execute(table.df, query(F.col("id") != 5) + (sort_on(*sort.sort, "id") + select_fields(["id", "name", "k"]))).collect()]
        page, got = read_page(table, req, size), []
        got += [str(tuple(r)) for r in page.rows.collect()]
        while page.cursor:
            page = read_page(table, req, size, page.cursor)
            part = [str(tuple(r)) for r in page.rows.collect()]
            assert len(part) == size or page.cursor is None
            got += part
        assert got == want


def test_a_write_in_between_is_not_seen(spark, people):
    req = query() + (sort_on(("k", "desc")) + select_fields(["id"]))
    want = [r.id for r in people.df.orderBy(F.col("k").desc_nulls_last(), "id").collect()]
    page = read_page(people, req, 300)
    got = [r.id for r in page.rows.collect()]
    latest = people.delete(got[:10]).upsert(spark.createDataFrame([(-1, "first", 99)], "id long, name string, k int"))
    again = [read_page(t, req, 300, page.cursor) for t in (latest, people, BucketedTable.open(spark, people.path))]
    assert all(got + [r.id for r in p.rows.collect()] == want and p.cursor is None for p in again)
    assert json.loads(page.cursor)["version"] == 0


def test_cursors_are_checked_and_pushed_to_the_scan(spark, people):
    page = read_page(people, query() + sort_on("name"), 10)
    with pytest.raises(ValueError, match="another order"):
        read_page(people, query() + sort_on("k"), 10, page.cursor)
    for bad in (query(size=3), sort_on("k")):
        with pytest.raises(ValueError):
            read_page(people, bad, 10)
    from docsift.plans import paging
    cond = paging._after([(F.col("name"), "asc", False), (F.col("id"), "asc", False)], [F.lit("n5"), F.lit(5)])
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(people.df.where(cond)._jdf.queryExecution(), "formatted")
    assert "GreaterThan(name,n5)" in plan.split("PushedFilters: [")[1].split("\n")[0]
