"""Query strings: what they read, what they match, and what they refuse."""

import datetime as dt
import random
import re

import pytest

from docsift.functions import predicates as P
from docsift.functions.query_string import QueryStringError, parse, query_string
from docsift.plans.search import execute, query


@pytest.fixture(scope="module")
def docs(spark):
    d = dt.datetime
    rows = [
        (1, "The quick brown fox", "Open", 5, 1.5, d(2024, 1, 1, 0, 0), ["red", "Dark Blue"], True, [("a", 1), ("b", 9)]),
        (2, "Quick: jumps; over-it!", "closed", 10, None, d(2024, 1, 1, 23, 59, 59), [], False, []),
        (3, None, "open", None, 20.0, None, None, None, None),
        (4, "jumping c++ (1:2) foo\\bar", "Open", 11, -3.0, d(2024, 1, 2), ["blue"], True, [("a", 9)]),
        (5, "", "", 0, 0.0, d(2023, 12, 31, 23, 0), ["", None], False, [("c", None)]),
    ]
    return spark.createDataFrame(rows, "id int, title string, status string, n int, x double, at timestamp_ntz, tags array<string>, ok boolean, "
                                       "items array<struct<k:string,v:int>>")


@pytest.mark.parametrize("text, ids", [
    ("", [1, 2, 3, 4, 5]), ("*", [1, 2, 3, 4, 5]), ("*:*", [1, 2, 3, 4, 5]),
    ("quick", [1, 2]), ("QUICK fox", [1, 2]), ("+quick +fox", [1]), ("quick -fox", [2]), ("-quick", [3, 4, 5]),
    ("title:quick AND NOT title:fox", [2]), ("NOT title:quick", [3, 4, 5]), ("!title:quick", [3, 4, 5]),
    ('"quick brown"', [1]), ('title:"brown quick"', []), ('"over it"', [2]), ("title:over-it", [2]), ("jump*", [2, 4]), ("title:j?mps", [2]),
    ("title:/jump(s|ing)/", [2, 4]), ("title:/jum/", []), ("qiuck~", [1, 2]), ("quik~1", [1, 2]), ("quik~0", []),
    ("status:open", [1, 3, 4]), ("status.keyword:Open", [1, 4]), ("status.keyword:O*", [1, 4]), ("status.keyword:/[oO]pen/", [1, 3, 4]),
    ("n:10", [2]), ("n:>10", [4]), ("n:>=10", [2, 4]), ("n:<5", [5]), ("n:[5 TO 10]", [1, 2]), ("n:{5 TO 10]", [2]), ("n:[5 TO 10}", [1]),
    ("n:[* TO 5]", [1, 5]), ("n:[11 TO *]", [4]), ("n:[* TO *]", [1, 2, 4, 5]), ("n:10.5", []), ("n:>10.5", [4]), ("x:-3", [4]), ("x:[-3 TO 0]", [4, 5]),
    ("at:2024-01-01", [1, 2]), ("at:<=2024-01-01", [1, 2, 5]), ("at:>2024-01-01", [4]), ("at:<2024-01-01", [5]),
    ("at:2024-01-01T23:59:59", [2]), ('at:["2024-01-01 00:00" TO 2024-01-01T12:00}', [1]), ("ok:true", [1, 4]), ("ok:FALSE", [2, 5]),
    ("tags:blue", [1, 4]), ("tags.keyword:blue", [4]), ('tags:"dark blue"', [1]), ("_exists_:tags", [1, 4, 5]), ("tags:*", [1, 4, 5]), ("NOT tags:*", [2, 3]),
    ("items.k:a AND items.v:9", [1, 4]), ("items.v:>5", [1, 4]), ("items.k:(b OR c)", [1, 5]), ("_exists_:items.v", [1, 4]),
    ("title:(quick AND (brown OR over-it)) AND n:5", [1]), ("status:open OR n:10 AND title:nothing", [1, 3, 4]), ("(status:open OR n:10) AND title:nothing", []),
    ("status:open n:10", [1, 2, 3, 4]), ("status:open && n:5 || n:0", [1, 5]), ("+status:open n:5 x:20", [1, 3, 4]), ("NOT NOT n:5", [1]),
    ("title:c\\+\\+", [4]), ("title:1\\:2", [4]), ('title:"1:2"', [4]), ("title:android", []), ("title:ORDER", []), ("  quick   ", [1, 2]), ("title:++", []),
])
def test_strings_match(docs, text, ids):
    assert sorted(r.id for r in execute(docs, query(query_string(text))).collect()) == ids


def test_operator_and_default_fields(docs):
    got = lambda text, **o: sorted(r.id for r in execute(docs, query(P.query_string(text, **o))).collect())
    assert got("quick fox", operator="and") == [1] and got("quick -fox", operator="and") == [2]
    assert got("open", fields=["title"]) == [] and got("open", fields=["status", "tags"]) == [1, 3, 4]
    with pytest.raises(ValueError):
        P.query_string("a", operator="xor")


@pytest.mark.parametrize("text, place", [
    ("a AND", 5), ("(a OR b", 0), ("a)", 1), ('"open', 0), ("n:[1 TO 2", 2), ("n:[1 2]", 2), ("AND a", 0), ("n:", 2), ("a OR OR b", 5), ("/x", 0), ("n:>", 3), ("a\\", 1),
    ("_exists_:", 9)])
def test_errors_name_the_place(text, place):
    with pytest.raises(QueryStringError) as e:
        parse(text)
    assert e.value.place == place


@pytest.mark.parametrize("text, place", [("nope:1", 0), ("id:1 OR n:abc", 10), ("n:1*", 2), ("ok:maybe", 3), ("at:yesterday", 3), ("n:[1 TO x]", 2)])
def test_strings_that_do_not_fit_the_frame(docs, text, place):
    with pytest.raises(QueryStringError) as e:
        execute(docs, query(query_string(text)))
    assert e.value.place == place


def test_random_conditions_equal_plain_evaluation(spark):
    """AND, OR, NOT, signs and brackets over words, with missing fields."""
    rng = random.Random(4)
    words = ["ant", "bee", "cat"]
    rows = [(i, None if i % 5 == 0 else " ".join(w for j, w in enumerate(words) if i >> j & 1), i % 3 if i % 7 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, t string, n int")
    holds = lambda r, w: r[1] is not None and w in r[1].split()

    def made(depth):
        kind = rng.choice(["word", "word", "num", "and", "or", "not", "list"] if depth else ["word", "num"])
        if kind == "word":
            w = rng.choice(words)
            return f"t:{w}", lambda r: holds(r, w)
        if kind == "num":
            k = rng.randrange(3)
            return f"n:{k}", lambda r: r[2] == k
        if kind == "not":
            s, f = made(depth - 1)
            return f"NOT ({s})", lambda r: not f(r)
        parts = [made(depth - 1) for _ in range(rng.randint(2, 3))]
        if kind == "list":
            signs = [rng.choice(["+", "-", ""]) for _ in parts]

            def check(r):
                must, free, never = ([f(r) for (_, f), g in zip(parts, signs) if g == s] for s in ("+", "", "-"))
                return all(must) and not any(never) and (bool(must) or not free or any(free))
            return " ".join(f"{g}({s})" for (s, _), g in zip(parts, signs)), check
        test = all if kind == "and" else any
        return f" {kind.upper()} ".join(f"({s})" for s, _ in parts), lambda r: test([f(r) for _, f in parts])

    made_up = [made(3) for _ in range(40)]
    bound = P.on(df)
    got = df.select("id", *[P.null_safe(query_string(s)(bound)).alias(f"c{i}") for i, (s, _) in enumerate(made_up)]).orderBy("id").collect()
    for i, (s, f) in enumerate(made_up):
        assert [r[f"c{i}"] for r in got] == [f(r) for r in rows], s


def test_simple_conditions_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = execute(df, query(query_string("value:[10 TO 40} AND event_type.keyword:click")))
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan)[1]
    assert "EqualTo(event_type,click)" in pushed and "GreaterThanOrEqual(value,10.0)" in pushed and "LessThan(value,40.0)" in pushed
