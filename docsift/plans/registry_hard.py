"""Registered queries on values that plain tables lack: several values in a
field, missing ids, NaN, huge numbers, repeated ids, nested aggregations. The
odd values are derived from the given tables in Spark and in SQL alike."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.mapping import create_table, drop_table, list_tables
from ..functions.text import tokens
from ..operators import bucket_series as S
from ..operators import buckets as B
from ..operators import metrics as M
from ..operators import write as W
from ..operators.ordered import positions
from ..operators.postings import PostingsIndex
from ..session import cut_lineage, scratch_path
from ..sources import documents as D
from .registry import docs_with_labels, r6, register, t
from .registry_aggs import bm25_sql, toks_sql
from .search import Resource, aggs, execute, query, select_fields, sort_on

# ================================================================ writes


@register("upsert_null_ids", """
SELECT o_orderkey < 0 OR o_orderkey IS NULL AS generated, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice
FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT o_orderkey, o_custkey, 'N', o_totalprice + 2, o_orderdate, o_orderpriority
                FROM orders WHERE o_orderstatus = 'P'
      UNION ALL SELECT NULL, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
                FROM orders WHERE o_orderstatus = 'F')
""")
def upsert_null_ids(spark, sf):
    """Rows without an id are all added; of two versions of an id, the one
    without an order value loses."""
    o = t(spark, sf, "orders")
    pending = o.filter(P.term("o_orderstatus", "P")).withColumn("o_orderstatus", F.lit("N"))
    v = [pending.withColumn("o_totalprice", F.col("o_totalprice") + i).withColumn("seq", F.lit(s).cast("int"))
         for i, s in ((1, 1), (2, 2), (3, None))]
    none = (o.filter(P.term("o_orderstatus", "F")).withColumn("o_orderkey", F.lit(None).cast("bigint"))
             .withColumn("seq", F.lit(None).cast("int")))
    out = W.upsert(o, v[0].union(v[1]).union(v[2]).union(none), "o_orderkey", "seq")
    return r6(out.select((F.col("o_orderkey") < 0).alias("generated"), "o_custkey", "o_orderstatus", "o_totalprice"))


@register("append_without_ids", """
SELECT c_mktsegment AS key, 2 * count(*) AS n, 2 * count(*) AS ids FROM customer GROUP BY 1
""")
def append_without_ids(spark, sf):
    """Identical rows without ids are documents of their own."""
    c = t(spark, sf, "customer").drop("c_custkey")
    out = W.upsert(W.assign_ids(c, "id"), c, "id")
    return out.groupBy(F.col("c_mktsegment").alias("key")).agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@register("delete_ids_of_type", """
SELECT * FROM (SELECT o_orderkey AS id, 'order' AS kind FROM orders UNION ALL SELECT c_custkey, 'customer' FROM customer)
WHERE NOT (kind = 'customer' AND id IN (1, 2, 3))
""")
def delete_ids_of_type(spark, sf):
    both = t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind")).union(
        t(spark, sf, "customer").select("c_custkey", F.lit("customer")))
    return Resource(spark, both, doc_type="customer", type_field="kind").delete(ids=["1", "2", 3, "999999999"])


@register("index_of_type", """
SELECT id, kind, CASE WHEN kind = 'customer' AND id <= 100 THEN 'new' ELSE 'old' END AS state
FROM (SELECT o_orderkey AS id, 'order' AS kind FROM orders UNION ALL SELECT c_custkey, 'customer' FROM customer)
""")
def index_of_type(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind"), F.lit("old").alias("state"))
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"), F.lit("old").alias("state"))
    new = c.filter("id <= 100").select("id", F.lit("new").alias("state"))
    return Resource(spark, o.union(c), doc_type="customer", type_field="kind").index(new)


@register("apply_actions_new_field", """
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment,
       CASE WHEN c_custkey % 3 = 0 THEN 'gold' END AS tier
FROM customer WHERE c_custkey % 3 <> 1
UNION ALL
SELECT c_custkey, NULL, NULL, round(c_acctbal, 6), NULL, 'silver' FROM customer WHERE c_custkey % 3 = 1
""")
def apply_actions_new_field(spark, sf):
    """A feed with a field the table lacks and without most of the table's."""
    c = t(spark, sf, "customer")
    feed = c.filter("c_custkey % 3 <> 2").select(
        "c_custkey", F.lit(1).alias("seq"), F.when(F.col("c_custkey") % 3 == 0, "update").otherwise("index").alias("action"),
        F.when(F.col("c_custkey") % 3 == 1, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 3 == 0, "gold").otherwise("silver").alias("tier"))
    return r6(W.apply_actions(c, feed, "c_custkey"))


@register("catalog_table", "SELECT o_orderstatus AS key, count(*) AS n, true AS was_listed, false AS is_listed FROM orders GROUP BY 1")
def catalog_table(spark, sf):
    """A typed table is created empty, listed, filled, read and dropped."""
    path = scratch_path(spark, "table")
    name = "t_" + path.rsplit("-", 1)[1]
    o = t(spark, sf, "orders")
    create_table(spark, name, o.schema, path)
    try:
        listed = bool(list_tables(spark, name).count()) and spark.table(name).count() == 0
        o.write.mode("append").insertInto(name)
        out = cut_lineage(spark.table(name).groupBy(F.col("o_orderstatus").alias("key")).agg(F.count("*").alias("n")))
    finally:
        drop_table(spark, name, approve=True)
    return out.withColumns({"was_listed": F.lit(listed), "is_listed": F.lit(bool(list_tables(spark, name).count()))})


# ================================================================ several values in a field

@register("q_array_range", """
SELECT vec_id FROM embeddings WHERE len([x FOR x IN embedding IF x >= 0.3::FLOAT AND x < 0.31::FLOAT]) > 0
""")
def q_array_range(spark, sf):
    """A clause on an array field holds if one element satisfies it."""
    req = query(lambda p: p.range_("embedding", gte=0.3, lt=0.31)) + select_fields(["vec_id"])
    return execute(t(spark, sf, "embeddings"), req)


def _orders_with_items(spark, sf):
    """Orders with their line items as an array of objects (a bounded group)."""
    items = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct(
        F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("qty"), F.col("l_partkey").alias("part"))).alias("items"))
    return t(spark, sf, "orders").select("o_orderkey", "o_orderstatus").join(items, "o_orderkey", "left")


@register("q_array_path", """
SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
  AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity IN (49, 50))
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity < 2)
""")
def q_array_path(spark, sf):
    """Clauses on paths into an array of objects, each for any element."""
    def where(p):
        return p.bool_(must=[p.term("items.flag", "R"), p.terms("items.qty", [49.0, 50.0])],
                       must_not=[p.range_("items.qty", lt=2)])
    return execute(_orders_with_items(spark, sf), query(where) + select_fields(["o_orderkey"]))


@register("q_nested_array", """
SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE l_returnflag = 'R' AND l_quantity >= 49
""")
def q_nested_array(spark, sf):
    """All conditions on the same element."""
    cond = P.nested("items", lambda x: (x["flag"] == "R") & (x["qty"] >= 49))
    return execute(_orders_with_items(spark, sf), query(cond) + select_fields(["o_orderkey"]))


@register("q_array_missing", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def q_array_missing(spark, sf):
    return execute(_orders_with_items(spark, sf), query(lambda p: p.missing("items.flag")) + select_fields(["o_orderkey"]))


@register("fields_in_array", """
SELECT o_orderkey, sum(l_quantity) AS qty, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
""")
def fields_in_array(spark, sf):
    """A path inside an array of objects selects that part of each element."""
    picked = execute(_orders_with_items(spark, sf), query() + select_fields(["o_orderkey", "items.qty"]))
    assert picked.schema["items"].dataType.elementType.names == ["qty"]
    return picked.filter("items is not null").select(
        "o_orderkey", F.expr("aggregate(items, 0D, (a, x) -> a + x.qty)").alias("qty"), F.size("items").cast("bigint").alias("n"))


@register("nested_array_buckets", """
SELECT l_returnflag AS key, count(*) AS doc_count, count(DISTINCT l_orderkey) AS parent_count
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1
""")
def nested_array_buckets(spark, sf):
    return B.nested_array_terms(_orders_with_items(spark, sf), "items", "flag", "o_orderkey")


@register("b_terms_array", f"""
SELECT term AS key, count(*) AS doc_count, count(DISTINCT role) AS roles
FROM (SELECT role, unnest(list_distinct({toks_sql('text')})) AS term FROM conversations) GROUP BY 1
""")
def b_terms_array(spark, sf):
    """One bucket for each element; a document counts once in each."""
    c = t(spark, sf, "conversations").select("role", tokens("text").alias("tokens"))
    return execute(c, aggs(x=B.terms("tokens", metrics={"roles": M.cardinality("role")})))


def _sorted_by_items(mode, order):
    return f"""
SELECT o_orderkey, rank FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {mode}(l_quantity) {order}, o_orderkey) AS rank
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) WHERE rank <= 25
"""


def _ranked_orders(spark, sf, *key):
    df = _orders_with_items(spark, sf).filter("items is not null").select("o_orderkey", F.col("items.qty").alias("qty"))
    top = execute(df, query(size=25) + sort_on(key, "o_orderkey"))
    # the order itself: ids in their places
    return top.agg(F.collect_list("o_orderkey").alias("ids")).select(F.posexplode("ids").alias("rank", "o_orderkey")).select(
        "o_orderkey", (F.col("rank") + 1).cast("bigint").alias("rank"))


@register("sort_array_asc", _sorted_by_items("min", "ASC"))
def sort_array_asc(spark, sf):
    return _ranked_orders(spark, sf, "qty", "asc")


@register("sort_array_desc", _sorted_by_items("max", "DESC"))
def sort_array_desc(spark, sf):
    return _ranked_orders(spark, sf, "qty", "desc")


@register("sort_array_mode_max", _sorted_by_items("max", "ASC"))
def sort_array_mode_max(spark, sf):
    return _ranked_orders(spark, sf, "qty", "asc", "last", "max")


@register("sort_array_mode_min", _sorted_by_items("min", "DESC"))
def sort_array_mode_min(spark, sf):
    return _ranked_orders(spark, sf, "qty", "desc", "last", "min")


@register("sorted_subset_all", "SELECT doc_id FROM documents")
def sorted_subset_all(spark, sf):
    """An unsized sort that returns (and reads) few fields."""
    return execute(t(spark, sf, "documents"), query() + (sort_on(("n_chars", "desc")) + select_fields(["doc_id"])))


@register("relevance_repeated_ids", f"""
WITH d AS (SELECT row_number() OVER () AS row, CASE WHEN doc_id % 3 > 0 THEN doc_id % 7 END AS doc_id, lang, n_chars,
             {toks_sql('text')} AS toks FROM documents),
st AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl, sum(list_contains(toks, 'esat')::INT) AS df0,
              sum(list_contains(toks, 'ndat')::INT) AS df1 FROM d),
tf AS (SELECT *, len(list_filter(toks, lambda w: w = 'esat'))::DOUBLE AS tf0,
              len(list_filter(toks, lambda w: w = 'ndat'))::DOUBLE AS tf1 FROM d WHERE lang = 'en'),
s AS (SELECT doc_id, n_chars,
        ln(1 + (n - df0 + 0.5) / (df0 + 0.5)) * tf0 * 2.2 / (tf0 + 1.2 * (0.25 + 0.75 * len(toks) / avgdl))
      + ln(1 + (n - df1 + 0.5) / (df1 + 0.5)) * tf1 * 2.2 / (tf1 + 1.2 * (0.25 + 0.75 * len(toks) / avgdl)) AS score FROM tf, st),
r AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id NULLS LAST) AS place FROM s)
SELECT doc_id, round(score, 6) AS score, place FROM r WHERE place <= 200
""")
def relevance_repeated_ids(spark, sf):
    """Relevance order over repeated and missing ids: whole rows are ranked,
    and the first 200 come with their places."""
    docs = t(spark, sf, "documents").withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 7))
    req = query(P.term("lang", "en"), size=200, rank=("text", "esat ndat", "doc_id")) + select_fields(["doc_id", "score"])
    top = positions(execute(docs, req), [], [F.round("score", 9).desc(), F.col("doc_id").asc_nulls_last()], position="place")
    return r6(top.withColumn("place", F.col("place") + 1))


# ================================================================ hard values

@register("m_extended_huge", """
SELECT count(*) AS v_count, min(v) AS v_min, max(v) AS v_max, round(avg(v::DOUBLE) / 1e9, 6) AS v_avg,
       round(var_pop(v::DOUBLE) / 1e18, 6) AS v_variance, round(sum(v::DOUBLE * v::DOUBLE) / 1e18 / count(*), 6) AS v_mean_square
FROM (SELECT 6000000000 + o_custkey * 100000 AS v FROM orders)
""")
def m_extended_huge(spark, sf):
    o = t(spark, sf, "orders").select((F.lit(6_000_000_000) + F.col("o_custkey") * 100_000).alias("v"))
    out = execute(o, aggs(v=M.extended_stats("v")))
    return out.select("v_count", "v_min", "v_max", F.round(F.col("v_avg") / 1e9, 6).alias("v_avg"),
                      F.round(F.col("v_variance") / 1e18, 6).alias("v_variance"),
                      F.round(F.col("v_sum_of_squares") / 1e18 / F.col("v_count"), 6).alias("v_mean_square"))


@register("m_weighted_huge", """
SELECT round(sum((2000000000 + l_linenumber)::DOUBLE * (2000000000 - l_linenumber)::DOUBLE)
             / sum((2000000000 - l_linenumber)::DOUBLE), 3) AS w FROM lineitem
""")
def m_weighted_huge(spark, sf):
    big = F.lit(2_000_000_000)
    df = t(spark, sf, "lineitem").select((big + F.col("l_linenumber")).cast("int").alias("v"),
                                         (big - F.col("l_linenumber")).cast("int").alias("n"))
    return execute(df, aggs(w=M.weighted_avg("v", "n"))).select(F.round("w", 3).alias("w"))


_ODD_VALUE = """CASE event_id % 10 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN NULL
                ELSE value - 40 END"""


@register("b_histogram_odd", f"""
SELECT floor(v / 10)::DOUBLE * 10 AS key, count(*) AS doc_count FROM (SELECT {_ODD_VALUE} AS v FROM events)
WHERE NOT isnan(v) AND NOT isinf(v) AND v IS NOT NULL GROUP BY 1
""")
def b_histogram_odd(spark, sf):
    odd = F.col("event_id") % 10
    v = (F.when(odd == 0, float("nan")).when(odd == 1, float("inf")).when(odd == 2, F.lit(None)).otherwise(F.col("value") - 40))
    return execute(t(spark, sf, "events").select(v.alias("v")), aggs(x=B.histogram("v", 10)))


@register("b_date_hist_far", """
SELECT date_trunc('hour', ts + INTERVAL 376 YEAR)::TIMESTAMP AS key, count(*) AS doc_count FROM events GROUP BY 1
UNION ALL
SELECT date_trunc('hour', ts - INTERVAL 200 YEAR)::TIMESTAMP AS key, count(*) AS doc_count FROM events GROUP BY 1
""")
def b_date_hist_far(spark, sf):
    e = t(spark, sf, "events")
    far = e.select(F.expr("ts + INTERVAL '376' YEAR").alias("ts")).union(e.select(F.expr("ts - INTERVAL '200' YEAR")))
    return execute(far, aggs(x=B.date_histogram("ts", calendar_interval="hour")))


for _unit in ("minute", "year"):
    def _by(spark, sf, unit=_unit):
        return execute(t(spark, sf, "events"), aggs(x=B.date_histogram("ts", calendar_interval=unit)))
    register(f"b_date_hist_{_unit}", f"SELECT date_trunc('{_unit}', ts)::TIMESTAMP AS key, count(*) AS doc_count FROM events GROUP BY 1")(_by)


@register("p_siblings_null", """
WITH b AS (SELECT l_linenumber AS key, avg(l_quantity) FILTER (WHERE l_linenumber <> 2 AND l_linenumber <> 5) AS m
           FROM lineitem GROUP BY 1)
SELECT round(min(m), 6) AS s_min, arg_min(key, m) AS s_min_key, round(max(m), 6) AS s_max, arg_max(key, m) AS s_max_key,
       round(avg(m), 6) AS s_avg, round(sum(m), 6) AS s_sum, count(m) AS s_count,
       round(quantile_cont(m, 0.25), 6) AS s_p25, round(quantile_cont(m, 0.9), 6) AS s_p90 FROM b
""")
def p_siblings_null(spark, sf):
    """Buckets without a metric are no extreme."""
    q = F.when(~F.col("l_linenumber").isin(2, 5), F.col("l_quantity"))
    b = execute(t(spark, sf, "lineitem"), aggs(x=B.terms("l_linenumber", metrics={"m": M.avg(q)})))
    return r6(S.siblings(b, "m", "s", percents=[25, 90]))


@register("q_regexp_line_end", """
SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 AND regexp_full_match(o_orderpriority, '[1-3]-.*')
""")
def q_regexp_line_end(spark, sf):
    """The pattern covers the whole value: a final line end is not left over."""
    o = t(spark, sf, "orders").withColumn("p", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
                                          .otherwise(F.concat("o_orderpriority", F.lit("\n"))))
    return execute(o, query(P.regexp("p", "[1-3]-.*")) + select_fields(["o_orderkey"]))


@register("infer_json_numbers", """
SELECT 'a' AS field, 1 AS n_types, count(*) AS n_docs FROM events HAVING count(*) > 0 UNION ALL
SELECT 'b', 2, count(*) FROM events HAVING count(*) > 0 UNION ALL
SELECT 'c', 1, count(*) FROM events HAVING count(*) > 0
""")
def infer_json_numbers(spark, sf):
    """Numbers of any scale and JSON null do not conflict; text does."""
    odd = F.col("event_id") % 3
    doc = F.concat(F.lit('{"a": '), F.when(odd == 0, "1").when(odd == 1, "1.5").otherwise("12.25"),
                   F.lit(', "b": '), F.when(odd == 0, "1").otherwise('"x"'), F.lit(', "c": '),
                   F.when(odd == 0, "null").otherwise("true"), F.lit("}"))
    out = D.infer_json_fields(t(spark, sf, "events").select(doc.alias("doc")), "doc")
    return out.select("field", F.col("n_types").cast("int").alias("n_types"), "n_docs")


@register("b_terms_field_called_key", """
SELECT event_type AS key, count(*) AS doc_count, round(sum(value), 6) AS total FROM events GROUP BY 1
""")
def b_terms_field_called_key(spark, sf):
    """A metric on a document field called key reads that field."""
    e = t(spark, sf, "events").select("event_type", F.col("value").alias("key"))
    return r6(execute(e, aggs(x=B.terms("event_type", metrics={"total": M.sum_("key")}))))


@register("null_objects", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS s, o_orderkey % 2 <> 0 AS none FROM orders")
def null_objects(spark, sf):
    """A missing object stays missing under field selection."""
    o = t(spark, sf, "orders")
    nested = o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.struct("o_orderstatus", "o_custkey")).alias("info"))
    out = execute(nested, query() + select_fields(["o_orderkey", "info.o_orderstatus"]))
    return out.select("o_orderkey", F.col("info.o_orderstatus").alias("s"), F.col("info").isNull().alias("none"))


# ================================================================ buckets in buckets

@register("b_hist_in_terms", """
SELECT event_type AS type, sum(count(*)) OVER (PARTITION BY event_type)::BIGINT AS type_doc_count,
       round(sum(sum(value)) OVER (PARTITION BY event_type) / sum(count(value)) OVER (PARTITION BY event_type), 6) AS type_mean,
       floor(value / 25)::DOUBLE * 25 AS hist, count(*) AS hist_doc_count, round(max(value), 6) AS hist_top
FROM events GROUP BY event_type, floor(value / 25)
""")
def b_hist_in_terms(spark, sf):
    spec = B.tree([("type", B.terms("event_type", metrics={"mean": M.avg("value")})),
                   ("hist", B.histogram("value", 25, metrics={"top": M.max_("value")}))])
    return r6(execute(t(spark, sf, "events"), aggs(x=spec)))


@register("b_terms_in_filters", """
WITH f AS (SELECT 'big' AS band, * FROM events WHERE value >= 50 UNION ALL
           SELECT 'early', * FROM events WHERE ts < TIMESTAMP '2024-01-10'),
l AS (SELECT band, event_type AS type, count(*) AS type_doc_count, round(avg(value), 6) AS type_mean,
             row_number() OVER (PARTITION BY band ORDER BY count(*) DESC, event_type) AS r FROM f GROUP BY 1, 2),
b AS (SELECT band, count(*) AS band_doc_count FROM f GROUP BY 1)
SELECT band, band_doc_count, type, type_doc_count, type_mean FROM l JOIN b USING (band) WHERE r <= 2
""")
def b_terms_in_filters(spark, sf):
    bands = B.filters({"big": P.range_("value", gte=50), "early": P.range_("ts", lt=dt.datetime(2024, 1, 10))})
    spec = B.tree([("band", bands), ("type", B.terms("event_type", metrics={"mean": M.avg("value")}), 2)])
    return r6(execute(t(spark, sf, "events"), query(P.match_all()) + aggs(x=spec)))


@register("b_three_levels", """
WITH x AS (SELECT l_returnflag AS flag, CASE WHEN l_quantity < 25 THEN 'low' ELSE 'high' END AS band,
                  date_trunc('year', l_shipdate)::TIMESTAMP AS year, l_extendedprice AS p FROM lineitem),
a AS (SELECT flag, count(*) AS flag_doc_count FROM x GROUP BY 1),
b AS (SELECT flag, band, count(*) AS band_doc_count FROM x GROUP BY 1, 2),
c AS (SELECT flag, band, year, count(*) AS year_doc_count, round(avg(p), 6) AS year_price FROM x GROUP BY 1, 2, 3)
SELECT * FROM c JOIN b USING (flag, band) JOIN a USING (flag)
""")
def b_three_levels(spark, sf):
    spec = B.tree([("flag", B.terms("l_returnflag")),
                   ("band", B.range_("l_quantity", [("low", None, 25.0), ("high", 25.0, None)])),
                   ("year", B.date_histogram("l_shipdate", calendar_interval="year", metrics={"price": M.avg("l_extendedprice")}))])
    return r6(execute(t(spark, sf, "lineitem"), aggs(x=spec)))


@register("m_top_hits_in_terms", """
SELECT event_type AS key, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank
FROM events WHERE value >= 20 QUALIFY rank <= 3
""")
def m_top_hits_in_terms(spark, sf):
    """The best documents of each bucket, over a query's rows."""
    best = B.spec_of(lambda df: B.top_hits(B.terms("event_type").keyed(df, "key"), ["key"], 3,
                                           [F.col("value").desc(), F.col("event_id").asc()]))
    out = execute(t(spark, sf, "events"), query(P.range_("value", gte=20)) + aggs(x=best))
    return out.select("key", "event_id", "value", F.col("rank").cast("bigint").alias("rank"))


@register("b_rare_field", """
SELECT o_custkey AS key, count(*) AS doc_count, round(avg(o_totalprice), 6) AS price FROM orders
WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) <= 2
""")
def b_rare_field(spark, sf):
    spec = B.rare_terms("o_custkey", max_doc_count=2, metrics={"price": M.avg("o_totalprice")})
    return r6(execute(t(spark, sf, "orders"), query(P.term("o_orderstatus", "F")) + aggs(x=spec)))


@register("b_significant_field", """
WITH c AS (SELECT d.source AS key, count(*) AS bg_count, count(*) FILTER (WHERE l.quality = 0) AS doc_count
           FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1),
n AS (SELECT sum(bg_count)::DOUBLE AS bg, sum(doc_count)::DOUBLE AS fg FROM c),
s AS (SELECT key, doc_count, bg_count, (doc_count / fg - bg_count / bg) * (doc_count / fg) / (bg_count / bg) AS score FROM c, n)
SELECT key, doc_count, bg_count, round(score, 6) AS score FROM s WHERE doc_count >= 1 AND score > 0
""")
def b_significant_field(spark, sf):
    return r6(execute(docs_with_labels(spark, sf), aggs(x=B.significant_terms("source", P.term("quality", 0)))))


@register("b_adjacency_metrics", """
SELECT * FROM (
  SELECT 'big' AS key, count(*) AS doc_count, round(avg(value), 6) AS mean FROM events WHERE value >= 50
  UNION ALL SELECT 'big&clicks', count(*), round(avg(value), 6) FROM events WHERE value >= 50 AND event_type = 'click'
  UNION ALL SELECT 'clicks', count(*), round(avg(value), 6) FROM events WHERE event_type = 'click') WHERE doc_count > 0
""")
def b_adjacency_metrics(spark, sf):
    named = {"clicks": P.term("event_type", "click"), "big": P.range_("value", gte=50)}
    return r6(execute(t(spark, sf, "events"), aggs(x=B.adjacency_matrix(named, metrics={"mean": M.avg("value")}))))


@register("b_filters_percentiles", """
SELECT 'big' AS key, count(*) AS doc_count, round(quantile_cont(value, 0.5), 6) AS p_p50 FROM events WHERE value >= 50
UNION ALL SELECT 'clicks', count(*), round(quantile_cont(value, 0.5), 6) FROM events WHERE event_type = 'click'
""")
def b_filters_percentiles(spark, sf):
    named = {"big": P.range_("value", gte=50), "clicks": P.term("event_type", "click")}
    return r6(execute(t(spark, sf, "events"), aggs(x=B.filters(named, metrics={"p": M.percentiles("value", [50])}))))


@register("metrics_beside_buckets", "SELECT round(avg(value), 6) AS mean FROM events")
def metrics_beside_buckets(spark, sf):
    """Beside buckets, each metric's result holds its own columns only."""
    got = execute(t(spark, sf, "events"), aggs(mean=M.avg("value"), top=M.max_("value"), by=B.terms("event_type")))
    assert got["top"].columns == ["top"]
    return r6(got["mean"])


_TOGETHER = {
    "type": B.terms("event_type", metrics={"mean": M.avg("value")}, exclude="click"),
    "user": B.terms("user_id", size=7, metrics={"top": M.stats("value")}),
    "hist": B.histogram("value", 20, min_doc_count=0),
    "day": B.date_histogram("ts", calendar_interval="day", metrics={"users": M.cardinality("user_id")}),
}


def _together(spark, sf, name):
    got = execute(t(spark, sf, "events"), query(P.range_("value", gte=5)) + aggs(**_TOGETHER))
    got["user" if name == "type" else "type"]  # planned by itself; with the next one all others share a scan
    return r6(got[name])


@register("together_terms", """
SELECT event_type AS key, count(*) AS doc_count, round(avg(value), 6) AS mean FROM events
WHERE value >= 5 AND event_type <> 'click' GROUP BY 1
""")
def together_terms(spark, sf):
    """Four aggregations over one scan; this one's result."""
    return _together(spark, sf, "type")


@register("together_sized", """
SELECT user_id AS key, count(*) AS doc_count, count(value) AS top_count, round(min(value), 6) AS top_min,
       round(max(value), 6) AS top_max, round(avg(value), 6) AS top_avg, round(sum(value), 6) AS top_sum
FROM events WHERE value >= 5 GROUP BY 1 ORDER BY doc_count DESC, key LIMIT 7
""")
def together_sized(spark, sf):
    return _together(spark, sf, "user")


@register("together_days", """
SELECT date_trunc('day', ts)::TIMESTAMP AS key, count(*) AS doc_count, count(DISTINCT user_id) AS users
FROM events WHERE value >= 5 GROUP BY 1
""")
def together_days(spark, sf):
    return _together(spark, sf, "day")


@register("b_filter", "SELECT count(*) AS doc_count, round(avg(value), 6) AS mean FROM events WHERE event_type = 'click'")
def b_filter(spark, sf):
    return r6(execute(t(spark, sf, "events"), aggs(x=B.filter_(P.term("event_type", "click"), {"mean": M.avg("value")}))))


@register("b_token_buckets", f"""
SELECT term AS key, count(*) AS doc_count, count(DISTINCT conv_id) AS convs
FROM (SELECT conv_id, unnest(list_distinct({toks_sql('text')})) AS term FROM conversations WHERE role = 'user')
GROUP BY 1 ORDER BY doc_count DESC, key LIMIT 20
""")
def b_token_buckets(spark, sf):
    """Token buckets beside a query, with a metric in each bucket."""
    spec = B.token_buckets("text", size=20, metrics={"convs": M.cardinality("conv_id")})
    return execute(t(spark, sf, "conversations"), query(P.term("role", "user")) + aggs(x=spec))


# ================================================================ several values in a field

_ITEMS = """items AS (SELECT l_orderkey AS k, list(l_quantity) AS qty, list(l_shipdate) AS day, list(l_returnflag) AS flag
  FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey, o_orderpriority, qty, day, flag FROM orders LEFT JOIN items ON k = o_orderkey)"""


def _orders_with_values(spark, sf):
    """Orders with arrays of their lines' quantities, days and flags."""
    lines = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_list(F.struct(F.col("l_quantity").alias("qty"), F.col("l_shipdate").alias("day"), F.col("l_returnflag").alias("flag"))).alias("items"))
    return t(spark, sf, "orders").select("o_orderkey", "o_orderpriority").join(lines, "o_orderkey", "left")


@register("m_stats_array", f"""
WITH {_ITEMS}, e AS (SELECT unnest(qty) AS q FROM o)
SELECT count(q) AS v_count, min(q) AS v_min, max(q) AS v_max, round(avg(q), 6) AS v_avg, round(sum(q), 6) AS v_sum,
       round(var_pop(q), 6) AS x_variance, count(DISTINCT q) AS n FROM e
""")
def m_stats_array(spark, sf):
    """Each element of an array counts as a value."""
    got = execute(_orders_with_values(spark, sf), aggs(v=M.stats("items.qty"), x=M.extended_stats("items.qty"), n=M.cardinality("items.qty")))
    return r6(got.select("v_count", "v_min", "v_max", "v_avg", "v_sum", "x_variance", "n"))


@register("m_percentiles_array", f"""
WITH {_ITEMS}, e AS (SELECT o_orderpriority AS key, unnest(qty) AS q FROM o),
d AS (SELECT o_orderpriority AS key, count(*) AS doc_count FROM o GROUP BY 1)
SELECT key, doc_count, round(quantile_cont(q, 0.5), 6) AS p_p50, round(quantile_cont(q, 0.9), 6) AS p_p90, round(avg(q), 6) AS mean
FROM d JOIN e USING (key) GROUP BY key, doc_count
""")
def m_percentiles_array(spark, sf):
    """Values count each, documents once."""
    spec = B.terms("o_orderpriority", metrics={"p": M.percentiles("items.qty", [50, 90]), "mean": M.avg("items.qty")})
    return r6(execute(_orders_with_values(spark, sf), aggs(x=spec)))


@register("b_histogram_array", f"""
WITH {_ITEMS}, e AS (SELECT DISTINCT o_orderkey, floor(unnest(qty) / 10) * 10 AS key FROM o)
SELECT key::DOUBLE AS key, count(*) AS doc_count FROM e GROUP BY 1
""")
def b_histogram_array(spark, sf):
    """A document is in the bucket of each of its values, once."""
    return execute(_orders_with_values(spark, sf), aggs(x=B.histogram("items.qty", 10)))


@register("b_date_histogram_array", f"""
WITH {_ITEMS}, e AS (SELECT DISTINCT o_orderkey, date_trunc('year', unnest(day))::TIMESTAMP AS key FROM o)
SELECT key, count(*) AS doc_count FROM e GROUP BY 1
""")
def b_date_histogram_array(spark, sf):
    return execute(_orders_with_values(spark, sf), aggs(x=B.date_histogram("items.day", calendar_interval="year")))


@register("b_range_array", f"""
WITH {_ITEMS}, r(key, lo, hi) AS (VALUES ('low', NULL, 10.0), ('mid', 10.0, 40.0), ('high', 40.0, NULL), ('none', 500.0, NULL))
SELECT key, lo::DOUBLE AS "from", hi::DOUBLE AS "to",
       count(o_orderkey) FILTER (WHERE len(list_filter(qty, lambda q: (lo IS NULL OR q >= lo) AND (hi IS NULL OR q < hi))) > 0) AS doc_count
FROM r LEFT JOIN o ON true GROUP BY ALL
""")
def b_range_array(spark, sf):
    ranges = [("low", None, 10.0), ("mid", 10.0, 40.0), ("high", 40.0, None), ("none", 500.0, None)]
    return execute(_orders_with_values(spark, sf), aggs(x=B.range_("items.qty", ranges)))


@register("b_filters_array", f"""
WITH {_ITEMS}, c AS (SELECT *, coalesce(list_contains(flag, 'R'), false) AS r, coalesce(list_max(qty) >= 45, false) AS big FROM o)
SELECT 'returned' AS key, count(*) AS doc_count, round(avg(list_sum(qty)), 6) AS mean FROM c WHERE r
UNION ALL SELECT 'big', count(*), round(avg(list_sum(qty)), 6) FROM c WHERE big
UNION ALL SELECT 'else', count(*), round(avg(list_sum(qty)), 6) FROM c WHERE NOT r AND NOT big
""")
def b_filters_array(spark, sf):
    """Conditions bound to the frame hold if they do for any element."""
    named = {"returned": lambda p: p.term("items.flag", "R"), "big": lambda p: p.range_("items.qty", gte=45)}
    df = _orders_with_values(spark, sf).withColumn("total", F.when(F.col("items").isNotNull(), F.aggregate("items", F.lit(0.0), lambda a, x: a + x["qty"])))
    return r6(execute(df, aggs(x=B.filters(named, other_bucket_key="else", metrics={"mean": M.avg("total")}))))


@register("b_adjacency_array", f"""
WITH {_ITEMS}, c AS (SELECT coalesce(list_contains(flag, 'A'), false) AS a, coalesce(list_contains(flag, 'N'), false) AS n,
                            coalesce(list_contains(flag, 'R'), false) AS r FROM o),
k AS (SELECT CASE WHEN a THEN 'A' END AS k FROM c UNION ALL SELECT CASE WHEN n THEN 'N' END FROM c UNION ALL SELECT CASE WHEN r THEN 'R' END FROM c
  UNION ALL SELECT CASE WHEN a AND n THEN 'A&N' END FROM c UNION ALL SELECT CASE WHEN a AND r THEN 'A&R' END FROM c
  UNION ALL SELECT CASE WHEN n AND r THEN 'N&R' END FROM c)
SELECT k AS key, count(*) AS doc_count FROM k WHERE k IS NOT NULL GROUP BY 1
""")
def b_adjacency_array(spark, sf):
    named = {f: (lambda p, f=f: p.term("items.flag", f)) for f in "RAN"}
    return execute(_orders_with_values(spark, sf), aggs(x=B.adjacency_matrix(named)))


@register("b_missing_empty_array", f"WITH {_ITEMS} SELECT count(*) AS doc_count FROM o WHERE qty IS NULL OR len(list_filter(qty, lambda q: q > 30)) = 0")
def b_missing_empty_array(spark, sf):
    """An empty array is missing, as it is for a search."""
    df = _orders_with_values(spark, sf).withColumn("large", F.filter("items", lambda x: x["qty"] > 30))
    return execute(df, aggs(x=B.missing("large")))


@register("fields_excluded_in_array", f"""
WITH {_ITEMS} SELECT o_orderkey, list_aggregate(flag, 'count') AS n, list_contains(flag, 'R') AS r, false AS has_qty FROM o WHERE flag IS NOT NULL
""")
def fields_excluded_in_array(spark, sf):
    """Excludes win inside an array of objects that is included whole."""
    df = _orders_with_values(spark, sf).where("items IS NOT NULL")
    out = execute(df, query() + select_fields(["*"], ["items.qty", "o_orderpriority"]))
    element = out.schema["items"].dataType.elementType
    return out.select("o_orderkey", F.size("items").cast("long").alias("n"), F.exists("items", lambda x: x["flag"] == "R").alias("r"),
                      F.lit("qty" in element.names).alias("has_qty"))


# ================================================================ values without variation

@register("m_weights_of_zero", """
SELECT l_returnflag AS key, count(*) AS doc_count, round(sum(l_quantity * w) / nullif(sum(w), 0), 6) AS mean
FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_linenumber END AS w FROM lineitem) GROUP BY 1
""")
def m_weights_of_zero(spark, sf):
    df = t(spark, sf, "lineitem").withColumn("w", F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_linenumber")))
    return r6(execute(df, aggs(x=B.terms("l_returnflag", metrics={"mean": M.weighted_avg("l_quantity", "w")}))))


@register("m_matrix_constant", """
SELECT count(*) AS m_count, round(covar_samp(l_quantity, 7), 6) AS m_l_quantity_c_covariance, NULL::DOUBLE AS m_l_quantity_c_correlation,
       round(corr(l_quantity, l_discount), 6) AS m_l_quantity_l_discount_correlation FROM lineitem
""")
def m_matrix_constant(spark, sf):
    """A field that does not vary has no correlation."""
    df = t(spark, sf, "lineitem").withColumn("c", F.lit(7.0))
    got = execute(df, aggs(m=M.matrix_stats(["l_quantity", "c", "l_discount"])))
    return r6(got.select("m_count", "m_l_quantity_c_covariance", "m_l_quantity_c_correlation", "m_l_quantity_l_discount_correlation"))


# ================================================================ query strings

@register("q_query_string", f"""
WITH d AS (SELECT conv_id, turn, {toks_sql('text')} AS toks, role, text FROM conversations)
SELECT conv_id, turn FROM d
WHERE (role = 'user' AND (list_contains(toks, 'esat') OR len(list_filter(toks, lambda w: starts_with(w, 'nda'))) > 0))
   OR (contains(' ' || array_to_string(toks, ' ') || ' ', ' the and ') AND NOT role = 'user')
   OR len(list_filter(toks, lambda w: levenshtein(w, 'thats') <= 1)) > 0
""")
def q_query_string(spark, sf):
    """Fields, words, forms, phrases, edits and brackets in one string."""
    text = '(role:user AND (text:esat OR text:nda*)) OR text:"the and" AND NOT role:user OR text:thats~1'
    return execute(t(spark, sf, "conversations"), query(P.query_string(text)) + select_fields(["conv_id", "turn"]))


@register("q_query_string_words", f"""
WITH d AS (SELECT conv_id, turn, {toks_sql('text')} AS toks, {toks_sql('role')} AS roles FROM conversations)
SELECT conv_id, turn FROM d
WHERE (list_contains(toks, 'in') OR list_contains(roles, 'in')) AND NOT (list_contains(toks, 'the') OR list_contains(roles, 'the'))
""")
def q_query_string_words(spark, sf):
    """Words without a field are looked for in all text; signs require and forbid."""
    return execute(t(spark, sf, "conversations"), query(P.query_string("+in -the user")) + select_fields(["conv_id", "turn"]))


@register("q_query_string_values", """
SELECT event_id FROM events
WHERE value >= 10 AND value < 40 AND event_type IN ('click', 'purchase') AND NOT user_id > 100
  AND (ts < TIMESTAMP '2024-01-06' OR ts >= TIMESTAMP '2024-01-20' AND ts <= TIMESTAMP '2024-01-25 12:00:00') AND value IS NOT NULL
""")
def q_query_string_values(spark, sf):
    """Ranges of numbers and times; a date is a whole day."""
    text = ("value:[10 TO 40} event_type:(click OR purchase) NOT user_id:>100 "
            "(ts:<=2024-01-05 OR ts:[2024-01-20 TO 2024-01-25T12:00:00]) _exists_:value")
    return execute(t(spark, sf, "events"), query(P.query_string(text, operator="and")) + select_fields(["event_id"]))


@register("q_query_string_array", f"""
WITH {_ITEMS} SELECT o_orderkey FROM o
WHERE (list_contains(flag, 'R') AND list_max(qty) > 45 OR qty IS NULL) AND NOT starts_with(o_orderpriority, '1')
""")
def q_query_string_array(spark, sf):
    """On arrays a condition holds if it does for any element; whole values."""
    text = "(items.flag:R AND items.qty:>45 OR NOT _exists_:items.qty) -o_orderpriority.keyword:1*"
    return execute(_orders_with_values(spark, sf), query(P.query_string(text)) + select_fields(["o_orderkey"]))


@register("q_any_field_array", f"""
WITH {_ITEMS} SELECT o_orderkey FROM o WHERE list_contains(flag, 'R') OR o_orderpriority LIKE '%URGENT%'
""")
def q_any_field_array(spark, sf):
    """Free text looks into arrays of text too."""
    df = _orders_with_values(spark, sf).withColumn("flags", F.col("items.flag"))
    return execute(df, query(P.any_field(df, "r urgent")) + select_fields(["o_orderkey"]))


# ================================================================ text index

def _index(spark, sf, docs=None):
    docs = t(spark, sf, "documents") if docs is None else docs
    return PostingsIndex.build(docs, scratch_path(spark, "postings"), "text", "doc_id")


_CHANGED = "(SELECT doc_id, CASE WHEN doc_id % 10 = 4 THEN 'esat of the new ' || text ELSE text END AS text FROM documents WHERE doc_id % 10 <> 3)"


def _changed_index(spark, sf):
    """The index after a feed that changes a tenth of the documents and
    removes another."""
    docs = t(spark, sf, "documents").select("doc_id", "text")
    index = _index(spark, sf, docs)
    last = F.col("doc_id") % 10
    feed = docs.where(last.isin(3, 4)).select("doc_id", F.lit(1).alias("seq"), F.when(last == 3, "delete").otherwise("index").alias("action"),
                                              F.concat(F.lit("esat of the new "), "text").alias("text"))
    index.refresh(docs, feed, "text", "doc_id")
    return index


@register("i_bm25", bm25_sql("documents", "doc_id", "text", ["esat", "ndat", "ated"], 10))
def i_bm25(spark, sf):
    """Ranked from the postings of three terms."""
    return r6(_index(spark, sf).bm25_top_k("esat ndat ated", 10).withColumnRenamed("id", "doc_id"))


@register("i_bm25_changed", bm25_sql(_CHANGED, "doc_id", "text", ["esat", "new"], 50))
def i_bm25_changed(spark, sf):
    """After a feed of actions: statistics and postings of the live documents."""
    return r6(_changed_index(spark, sf).bm25_top_k("esat new", 50).withColumnRenamed("id", "doc_id"))


@register("i_bm25_compacted", bm25_sql(_CHANGED, "doc_id", "text", ["esat", "new"], 50))
def i_bm25_compacted(spark, sf):
    small = _changed_index(spark, sf).compact(scratch_path(spark, "postings"))
    return r6(small.bm25_top_k("esat new", 50).withColumnRenamed("id", "doc_id"))


@register("i_phrase", f"""
SELECT doc_id FROM documents WHERE contains(' ' || array_to_string({toks_sql('text')}, ' ') || ' ', ' of the ')
""")
def i_phrase(spark, sf):
    """Words that follow each other, from their places."""
    return _index(spark, sf).phrase("Of the").withColumnRenamed("id", "doc_id")


@register("i_match_and", f"SELECT doc_id FROM documents WHERE list_has_all({toks_sql('text')}, ['in', 'the', 'esat'])")
def i_match_and(spark, sf):
    return _index(spark, sf).match("in the esat", operator="and").withColumnRenamed("id", "doc_id")


@register("i_match_changed", f"""
SELECT doc_id FROM {_CHANGED} WHERE len(list_intersect(list_distinct({toks_sql('text')}), ['esat', 'ndat', 'ated', 'new'])) >= 2
""")
def i_match_changed(spark, sf):
    return _changed_index(spark, sf).match("esat ndat ated new", minimum_should_match=2).withColumnRenamed("id", "doc_id")


# ================================================================ documents set aside

_BROKEN = """e AS (SELECT event_id, value, CASE event_id % 12 WHEN 0 THEN substr(props, 1, 4) WHEN 1 THEN '[' || props || ']'
  WHEN 2 THEN '{"k": "x' || event_id || '"}' WHEN 3 THEN NULL WHEN 4 THEN '{"k": null, "tag": "t"}'
  WHEN 5 THEN CASE WHEN event_id % 24 = 5 THEN '{"k": 0.5, "tag": [1]}' ELSE '{"k": 0.5}' END ELSE props END AS doc FROM events)"""


def _broken_documents(spark, sf):
    rest = F.col("event_id") % 12
    doc = (F.when(rest == 0, F.substring("props", 1, 4)).when(rest == 1, F.concat(F.lit("["), "props", F.lit("]")))
           .when(rest == 2, F.concat(F.lit('{"k": "x'), "event_id", F.lit('"}'))).when(rest == 3, F.lit(None))
           .when(rest == 4, F.lit('{"k": null, "tag": "t"}')).when(F.col("event_id") % 24 == 5, F.lit('{"k": 0.5, "tag": [1]}')).when(rest == 5, F.lit('{"k": 0.5}'))
           .otherwise(F.col("props")))
    return D.typed_documents(t(spark, sf, "events").withColumn("doc", doc), "doc", ["event_id"])


@register("infer_json_quarantine", f"""
WITH {_BROKEN} SELECT CASE event_id % 12 WHEN 0 THEN 'malformed' WHEN 1 THEN 'not an object' WHEN 3 THEN 'no document'
  WHEN 2 THEN 'conflict: k is string, elsewhere number' ELSE 'conflict: tag is array, elsewhere string' END AS reason,
  count(*) AS n, min(event_id) AS first FROM e
WHERE event_id % 12 < 4 OR event_id % 24 = 5 GROUP BY 1
""")
def infer_json_quarantine(spark, sf):
    """Every document is a row or set aside with its reason."""
    out = _broken_documents(spark, sf).rejected
    return out.groupBy("reason").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))


@register("json_typed", f"""
WITH {_BROKEN} SELECT event_id, CASE WHEN event_id % 12 = 5 THEN 0.5 WHEN event_id % 12 <> 4 THEN (props->>'$.k')::DOUBLE END AS k,
  CASE WHEN event_id % 12 = 4 THEN 't' END AS tag FROM events WHERE event_id % 12 >= 4 AND event_id % 24 <> 5
""")
def json_typed(spark, sf):
    """Typed columns of the documents that agree: whole numbers and fractions are one kind."""
    out = _broken_documents(spark, sf)
    have = lambda f, kind: (F.col(f) if f in out.types else F.lit(None)).cast(kind).alias(f)  # noqa: E731  no documents: no fields
    return out.rows.select("event_id", have("k", "double"), have("tag", "string"))


# ================================================================ parents, best rows, levels

@register("b_reverse_nested_metrics", """
WITH e AS (SELECT DISTINCT l_returnflag AS key, l_orderkey FROM lineitem),
p AS (SELECT key, count(*) AS parent_count, round(sum(o_totalprice), 2) AS total, round(max(o_totalprice), 6) AS top
      FROM e JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
d AS (SELECT l_returnflag AS key, count(*) AS doc_count, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1)
SELECT * FROM d JOIN p USING (key)
""")
def b_reverse_nested_metrics(spark, sf):
    """Orders under the buckets of their lines, each once per bucket."""
    lines, orders = B.by_parent(t(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), t(spark, sf, "orders"), "o_orderkey")
    spec = B.nested_terms("l_returnflag", "o_orderkey", metrics={"mean": M.avg("l_quantity")},
                          parent_metrics={"total": M.sum_("o_totalprice"), "top": M.max_("o_totalprice")}, parents=orders)
    out = spec.run(lines)
    return r6(out.withColumn("total", F.round("total", 2)))


@register("b_top_hits_in_tree", """
WITH x AS (SELECT event_type AS type, date_trunc('week', ts)::TIMESTAMP AS week, event_id, value FROM events),
a AS (SELECT type, count(*) AS type_doc_count FROM x GROUP BY 1),
b AS (SELECT type, week, count(*) AS week_doc_count FROM x GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY type, week ORDER BY value DESC, event_id) AS place FROM x)
SELECT r.type, type_doc_count, r.week, week_doc_count, place, event_id, value
FROM r JOIN a USING (type) JOIN b ON r.type = b.type AND r.week = b.week WHERE place <= 2
""")
def b_top_hits_in_tree(spark, sf):
    """Best rows as a metric of a level inside another."""
    hits = M.top_hits(2, [("value", "desc"), ("event_id", "asc")], ["event_id", "value"])
    spec = B.tree([("type", B.terms("event_type")), ("week", B.date_histogram("ts", calendar_interval="week", metrics={"best": hits}))])
    out = execute(t(spark, sf, "events"), aggs(x=spec))
    return out.select("type", "type_doc_count", "week", "week_doc_count", F.posexplode("week_best").alias("place", "hit")).select(
        "type", "type_doc_count", "week", "week_doc_count", (F.col("place") + 1).cast("bigint").alias("place"), "hit.event_id", "hit.value")


@register("b_levels_rolled_up", """
WITH x AS (SELECT l_returnflag AS flag, CASE WHEN l_quantity <> 7 THEN floor(l_quantity / 10)::DOUBLE * 10 END AS band, date_trunc('year', l_shipdate)::TIMESTAMP AS year,
                  l_extendedprice AS p, l_discount AS d FROM lineitem),
a AS (SELECT flag, count(*) AS flag_doc_count, round(avg(p), 6) AS flag_mean, max(d) AS flag_top FROM x GROUP BY 1),
g AS (SELECT flag, band, count(*) AS band_doc_count, count(p) AS band_p_count, min(p) AS band_p_min, max(p) AS band_p_max,
             round(avg(p), 6) AS band_p_avg, round(sum(p), 2) AS band_p_sum FROM x WHERE band IS NOT NULL GROUP BY flag, band),
b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY flag ORDER BY band_doc_count DESC, band) <= 3),
c AS (SELECT flag, band, year, count(*) AS year_doc_count, round(sum(d), 6) AS year_d FROM x WHERE band IS NOT NULL GROUP BY 1, 2, 3)
SELECT * FROM c JOIN b USING (flag, band) JOIN a USING (flag)
""")
def b_levels_rolled_up(spark, sf):
    """Three levels with metrics from one scan; a row in no lower bucket
    still counts in the upper one."""
    df = t(spark, sf, "lineitem").withColumn("qty", F.when(F.col("l_quantity") != 7, F.col("l_quantity")))
    spec = B.tree([("flag", B.terms("l_returnflag", metrics={"mean": M.avg("l_extendedprice"), "top": M.max_("l_discount")})),
                   ("band", B.histogram("qty", 10, metrics={"p": M.stats("l_extendedprice")}), 3),
                   ("year", B.date_histogram("l_shipdate", calendar_interval="year", metrics={"d": M.sum_("l_discount")}))])
    out = r6(execute(df, aggs(x=spec)))
    return out.withColumn("band_p_sum", F.round("band_p_sum", 2))
