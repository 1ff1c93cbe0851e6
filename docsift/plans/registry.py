"""Registered queries: each operator of the inventory run over the given
tables, next to an equivalent SQL statement used as an independent oracle.

Every query reads whole tables (or frames Spark derives from them). Floating
results are rounded to 6 decimals on both sides so the comparison does not
depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import predicates as P
from ..operators import buckets as B
from ..operators import metrics as M
from ..session import read_table
from .search import Resource, aggs, execute, query, select_fields, sort_on

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every double / float column to 6 decimals."""
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def t(spark, sf, name):
    return read_table(spark, sf, name)


def docs_with_labels(spark, sf) -> DataFrame:
    """documents LEFT JOIN labels: the only source of missing values."""
    return t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id", "left")


# ================================================================ flagship

def flagship(spark: SparkSession, sf: str) -> DataFrame:
    events = Resource(spark, f"{sf}/events.parquet")
    req = query(P.range_("value", gte=10)) + aggs(
        by_type=B.terms("event_type", size=10, metrics={"avg_value": M.avg("value")}))
    return r6(events.search(req))


register("terms_avg", """
SELECT event_type AS key, count(*) AS doc_count, round(avg(value), 6) AS avg_value
FROM events WHERE value >= 10 GROUP BY event_type ORDER BY doc_count DESC, key LIMIT 10
""")(flagship)


# ================================================================ resources and search

@register("open_typed", "SELECT * FROM events WHERE event_type = 'click'")
def open_typed(spark, sf):
    return Resource(spark, f"{sf}/events.parquet", doc_type="click", type_field="event_type").df


@register("list_fields", "SELECT column_name AS field FROM (DESCRIBE SELECT * FROM events)")
def list_fields_q(spark, sf):
    return Resource(spark, f"{sf}/events.parquet").fields().select("field")


@register("match_all", "SELECT * FROM nation")
def match_all(spark, sf):
    return execute(t(spark, sf, "nation"), query(P.match_all()))


@register("all_rows", "SELECT * FROM orders")
def all_rows(spark, sf):
    return execute(t(spark, sf, "orders"), query())


@register("sort_multi", "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey")
def sort_multi(spark, sf):
    return execute(t(spark, sf, "orders"), query() + sort_on(("o_orderdate", "desc"), "o_orderkey"))


@register("top_k", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(spark, sf):
    return execute(t(spark, sf, "orders"),
                   query(size=10) + sort_on(("o_totalprice", "desc"), ("o_orderkey", "asc")))


@register("select_includes",
          "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def select_includes(spark, sf):
    return execute(t(spark, sf, "orders"), query() + select_fields(["o_order*", "o_custkey"]))


@register("select_excludes", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def select_excludes(spark, sf):
    return execute(t(spark, sf, "orders"), query() + select_fields(["*"], ["o_total*", "o_orderpriority"]))


@register("sorted_subset", """
SELECT c_name, c_mktsegment FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20
""")
def sorted_subset(spark, sf):
    req = query(size=20) + (select_fields(["c_name", "c_mktsegment"]) +
                            sort_on(("c_acctbal", "desc"), "c_custkey"))
    return execute(t(spark, sf, "customer"), req)


@register("compose", """
SELECT event_id, value FROM events WHERE event_type = 'purchase'
ORDER BY value DESC, event_id LIMIT 15
""")
def compose(spark, sf):
    partial = sort_on(("value", "desc"), "event_id") + select_fields(["event_id", "value"])
    return execute(t(spark, sf, "events"), partial + query(P.term("event_type", "purchase"), size=15))


@register("q_term", "SELECT * FROM events WHERE event_type = 'purchase'")
def q_term(spark, sf):
    return execute(t(spark, sf, "events"), query(P.term("event_type", "purchase")))


@register("q_terms", "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def q_terms(spark, sf):
    return execute(t(spark, sf, "orders"), query(P.terms("o_orderpriority", ["1-URGENT", "2-HIGH"])))


@register("q_range", """
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
WHERE l_quantity >= 10 AND l_quantity < 20 AND l_shipdate >= TIMESTAMP '1996-01-01'
""")
def q_range(spark, sf):
    import datetime as dt
    where = P.range_("l_quantity", gte=10, lt=20) & P.range_("l_shipdate", gte=dt.datetime(1996, 1, 1))
    return execute(t(spark, sf, "lineitem"),
                   query(where) + select_fields(["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"]))


@register("q_exists", """
SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL
""")
def q_exists(spark, sf):
    return execute(docs_with_labels(spark, sf),
                   query(P.not_(P.exists("quality"))) + select_fields(["doc_id", "lang"]))


@register("q_not_toxic", """
SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE NOT coalesce(l.toxic = 1, false)
""")
def q_not_toxic(spark, sf):
    return execute(docs_with_labels(spark, sf), query(P.not_(P.term("toxic", 1))) + select_fields(["doc_id"]))


@register("q_ids", "SELECT * FROM orders WHERE o_orderkey IN (1, 7, 42, 1000, 99999999)")
def q_ids(spark, sf):
    return execute(t(spark, sf, "orders"), query(P.ids([1, 7, 42, 1000, 99999999], id_field="o_orderkey")))


@register("q_prefix", "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'blue')")
def q_prefix(spark, sf):
    return execute(t(spark, sf, "part"), query(P.prefix("p_name", "blue")) + select_fields(["p_partkey", "p_name"]))


@register("q_wildcard", "SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1_'")
def q_wildcard(spark, sf):
    return execute(t(spark, sf, "part"),
                   query(P.wildcard("p_brand", "Brand#1?")) + select_fields(["p_partkey", "p_brand"]))


@register("q_regexp", "SELECT p_partkey, p_brand FROM part WHERE regexp_full_match(p_brand, 'Brand#[12][0-9]')")
def q_regexp(spark, sf):
    return execute(t(spark, sf, "part"),
                   query(P.regexp("p_brand", "Brand#[12][0-9]")) + select_fields(["p_partkey", "p_brand"]))


@register("q_fuzzy", """
SELECT c_custkey, c_mktsegment FROM customer WHERE levenshtein(lower(c_mktsegment), 'machinary') <= 2
""")
def q_fuzzy(spark, sf):
    return execute(t(spark, sf, "customer"),
                   query(P.fuzzy("c_mktsegment", "MACHINARY", 2)) + select_fields(["c_custkey", "c_mktsegment"]))


@register("q_bool", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity >= 30 AND NOT (l_linestatus = 'F')
  AND ((l_discount > 0.05)::INT + (l_tax > 0.05)::INT) >= 1
""")
def q_bool(spark, sf):
    where = P.bool_(must=[P.term("l_returnflag", "R")], filter=[P.range_("l_quantity", gte=30)],
                    should=[P.range_("l_discount", gt=0.05), P.range_("l_tax", gt=0.05)],
                    must_not=[P.term("l_linestatus", "F")], minimum_should_match=1)
    return execute(t(spark, sf, "lineitem"),
                   query(where) + select_fields(["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"]))


@register("q_sort_missing", """
SELECT d.doc_id, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
ORDER BY l.toxic DESC NULLS FIRST, d.doc_id LIMIT 700
""")
def q_sort_missing(spark, sf):
    req = query(size=700) + (sort_on(("toxic", "desc", "first"), "doc_id") + select_fields(["doc_id", "toxic"]))
    return execute(docs_with_labels(spark, sf), req)


# ================================================================ metrics

@register("global_avg", "SELECT round(avg(l_extendedprice), 6) AS avg_price FROM lineitem")
def global_avg(spark, sf):
    return r6(execute(t(spark, sf, "lineitem"), aggs(avg_price=M.avg("l_extendedprice"))))


@register("global_multi", """
SELECT round(sum(l_quantity), 6) AS sum_qty, round(min(l_discount), 6) AS min_disc,
       round(max(l_tax), 6) AS max_tax, round(avg(l_extendedprice), 6) AS avg_price FROM lineitem
""")
def global_multi(spark, sf):
    return r6(execute(t(spark, sf, "lineitem"), aggs(
        sum_qty=M.sum_("l_quantity"), min_disc=M.min_("l_discount"),
        max_tax=M.max_("l_tax"), avg_price=M.avg("l_extendedprice"))))


@register("terms_count", """
SELECT l_returnflag AS key, count(*) AS doc_count FROM lineitem GROUP BY 1
""")
def terms_count(spark, sf):
    return execute(t(spark, sf, "lineitem"), aggs(flags=B.terms("l_returnflag", size=None)))


@register("terms_top", """
SELECT o_custkey AS key, count(*) AS doc_count FROM orders GROUP BY 1 ORDER BY doc_count DESC, key LIMIT 10
""")
def terms_top(spark, sf):
    return execute(t(spark, sf, "orders"), aggs(top_customers=B.terms("o_custkey", size=10)))


@register("query_then_aggs", """
SELECT event_type AS key, count(*) AS doc_count, round(sum(value), 6) AS total FROM events
WHERE value >= 50 GROUP BY 1
""")
def query_then_aggs(spark, sf):
    req = query(P.range_("value", gte=50)) + aggs(t=B.terms("event_type", size=None,
                                                              metrics={"total": M.sum_("value")}))
    return r6(execute(t(spark, sf, "events"), req))


def _multi(spark, sf):
    return execute(t(spark, sf, "events"), aggs(
        by_type=B.terms("event_type", size=None),
        by_user=B.terms("user_id", size=5),
        avg_value=M.avg("value")))


@register("multi_aggs_by_type", "SELECT event_type AS key, count(*) AS doc_count FROM events GROUP BY 1")
def multi_aggs_by_type(spark, sf):
    return _multi(spark, sf)["by_type"]


@register("multi_aggs_by_user", """
SELECT user_id AS key, count(*) AS doc_count FROM events GROUP BY 1 ORDER BY doc_count DESC, key LIMIT 5
""")
def multi_aggs_by_user(spark, sf):
    return _multi(spark, sf)["by_user"]


@register("multi_aggs_avg", "SELECT round(avg(value), 6) AS avg_value FROM events")
def multi_aggs_avg(spark, sf):
    return r6(_multi(spark, sf)["avg_value"])


@register("m_basic", """
SELECT l_returnflag AS key, count(*) AS doc_count, round(sum(l_quantity), 6) AS qty_sum,
       round(min(l_quantity), 6) AS qty_min, round(max(l_quantity), 6) AS qty_max
FROM lineitem GROUP BY 1
""")
def m_basic(spark, sf):
    return r6(execute(t(spark, sf, "lineitem"), aggs(x=B.terms("l_returnflag", size=None, metrics={
        "qty_sum": M.sum_("l_quantity"), "qty_min": M.min_("l_quantity"), "qty_max": M.max_("l_quantity")}))))


@register("m_value_count", """
SELECT d.lang AS key, count(*) AS doc_count, count(l.quality) AS labelled
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1
""")
def m_value_count(spark, sf):
    return execute(docs_with_labels(spark, sf),
                   aggs(x=B.terms("lang", size=None, metrics={"labelled": M.value_count("quality")})))


@register("m_stats", """
SELECT event_type AS key, count(*) AS doc_count, count(value) AS v_count, round(min(value), 6) AS v_min,
       round(max(value), 6) AS v_max, round(avg(value), 6) AS v_avg, round(sum(value), 6) AS v_sum
FROM events GROUP BY 1
""")
def m_stats(spark, sf):
    return r6(execute(t(spark, sf, "events"), aggs(x=B.terms("event_type", size=None,
                                                               metrics={"v": M.stats("value")}))))


@register("m_ext_stats", """
SELECT event_type AS key, count(*) AS doc_count, count(value) AS v_count, round(min(value), 6) AS v_min,
       round(max(value), 6) AS v_max, round(avg(value), 6) AS v_avg, round(sum(value), 6) AS v_sum,
       round(sum(value * value), 6) AS v_sum_of_squares, round(var_pop(value), 6) AS v_variance,
       round(stddev_pop(value), 6) AS v_std_deviation,
       round(avg(value) + 2 * stddev_pop(value), 6) AS v_std_upper,
       round(avg(value) - 2 * stddev_pop(value), 6) AS v_std_lower
FROM events GROUP BY 1
""")
def m_ext_stats(spark, sf):
    return r6(execute(t(spark, sf, "events"), aggs(x=B.terms("event_type", size=None,
                                                               metrics={"v": M.extended_stats("value")}))))


@register("m_cardinality", """
SELECT o_orderstatus AS key, count(*) AS doc_count, count(DISTINCT o_custkey) AS customers
FROM orders GROUP BY 1
""")
def m_cardinality(spark, sf):
    return execute(t(spark, sf, "orders"), aggs(x=B.terms("o_orderstatus", size=None,
                                                            metrics={"customers": M.cardinality("o_custkey")})))


@register("m_percentiles", """
SELECT event_type AS key, count(*) AS doc_count,
       round(quantile_cont(value, 0.25), 6) AS v_p25, round(quantile_cont(value, 0.5), 6) AS v_p50,
       round(quantile_cont(value, 0.75), 6) AS v_p75, round(quantile_cont(value, 0.95), 6) AS v_p95
FROM events GROUP BY 1
""")
def m_percentiles(spark, sf):
    return r6(execute(t(spark, sf, "events"), aggs(x=B.terms("event_type", size=None, metrics={
        "v": M.percentiles("value", [25, 50, 75, 95])}))))


@register("m_pct_ranks", """
SELECT event_type AS key, count(*) AS doc_count,
       round(avg(CASE WHEN value <= 10 THEN 1.0 ELSE 0.0 END) * 100, 6) AS v_10,
       round(avg(CASE WHEN value <= 50 THEN 1.0 ELSE 0.0 END) * 100, 6) AS v_50
FROM events GROUP BY 1
""")
def m_pct_ranks(spark, sf):
    return r6(execute(t(spark, sf, "events"), aggs(x=B.terms("event_type", size=None, metrics={
        "v": M.percentile_ranks("value", [10, 50])}))))


@register("m_mad", """
SELECT event_type AS key, count(*) AS doc_count, round(mad(value), 6) AS v_mad FROM events GROUP BY 1
""")
def m_mad(spark, sf):
    return r6(execute(t(spark, sf, "events"), aggs(x=B.terms("event_type", size=None, metrics={
        "v_mad": M.median_absolute_deviation("value")}))))


@register("m_weighted", """
SELECT l_returnflag AS key, count(*) AS doc_count,
       round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 6) AS wavg
FROM lineitem GROUP BY 1
""")
def m_weighted(spark, sf):
    return r6(execute(t(spark, sf, "lineitem"), aggs(x=B.terms("l_returnflag", size=None, metrics={
        "wavg": M.weighted_avg("l_extendedprice", "l_quantity")}))))


@register("m_top_hits", """
SELECT o_orderpriority, o_orderkey, o_totalprice, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank
  FROM orders) WHERE rank <= 3
""")
def m_top_hits(spark, sf):
    o = t(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return B.top_hits(o, ["o_orderpriority"], 3, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]) \
        .withColumn("rank", F.col("rank").cast("bigint"))


@register("m_string_stats", """
WITH lens AS (
  SELECT p_type AS key, count(*) AS doc_count, count(p_name) AS s_count, min(length(p_name)) AS s_min_length,
         max(length(p_name)) AS s_max_length, round(avg(length(p_name)), 6) AS s_avg_length
  FROM part GROUP BY 1),
chars AS (
  SELECT p_type AS key, ch, count(*) AS n FROM (SELECT p_type, unnest(string_split(p_name, '')) AS ch FROM part)
  WHERE ch <> '' GROUP BY 1, 2),
ent AS (
  SELECT key, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) AS s_entropy FROM chars GROUP BY 1)
SELECT lens.*, ent.s_entropy FROM lens LEFT JOIN ent USING (key)
""")
def m_string_stats(spark, sf):
    out = execute(t(spark, sf, "part"), aggs(x=B.terms("p_type", size=None, metrics={"s": M.string_stats("p_name")})))
    return r6(out.withColumn("s_min_length", F.col("s_min_length").cast("bigint"))
                 .withColumn("s_max_length", F.col("s_max_length").cast("bigint")))


@register("m_matrix", """
SELECT count(*) AS m_count,
  round(avg(l_quantity), 6) AS m_l_quantity_mean, round(var_samp(l_quantity), 6) AS m_l_quantity_variance,
  round(avg(l_discount), 6) AS m_l_discount_mean, round(var_samp(l_discount), 6) AS m_l_discount_variance,
  round(covar_samp(l_quantity, l_discount), 6) AS m_l_quantity_l_discount_covariance,
  round(corr(l_quantity, l_discount), 6) AS m_l_quantity_l_discount_correlation
FROM lineitem
""")
def m_matrix(spark, sf):
    return r6(execute(t(spark, sf, "lineitem"), aggs(m=M.matrix_stats(["l_quantity", "l_discount"]))))


# the remaining groups register themselves on import
from . import registry_aggs  # noqa: E402,F401
from . import registry_write  # noqa: E402,F401
from . import registry_hard  # noqa: E402,F401


# ================================================================ approximate options: sketches differ between
# engines, so these compare them with the exact values and say whether they keep their stated error

@register("m_cardinality_approx", """
SELECT o_orderstatus AS key, count(*) AS doc_count, count(DISTINCT o_custkey) AS customers, true AS within FROM orders
GROUP BY 1
""")
def m_cardinality_approx(spark, sf):
    out = execute(t(spark, sf, "orders"), aggs(x=B.terms("o_orderstatus", metrics={
        "customers": M.cardinality("o_custkey"), "sketch": M.cardinality("o_custkey", approx=True, rsd=0.05)})))
    off = F.abs(F.col("sketch") - F.col("customers"))
    return out.select("key", "doc_count", "customers", (off <= 3 * 0.05 * F.col("customers")).alias("within"))


@register("m_percentiles_approx", """
SELECT event_type AS key, count(*) AS doc_count, true AS p25, true AS p50, true AS p75, true AS p95 FROM events GROUP BY 1
""")
def m_percentiles_approx(spark, sf):
    around = [q for p in (25, 50, 75, 95) for q in (p - 1, p + 1)]
    out = execute(t(spark, sf, "events"), aggs(x=B.terms("event_type", metrics={
        "v": M.percentiles("value", [25, 50, 75, 95], approx=True), "x": M.percentiles("value", around)})))
    return out.select("key", "doc_count", *[F.col(f"v_p{p}").between(F.col(f"x_p{p - 1}"), F.col(f"x_p{p + 1}"))
                                            .alias(f"p{p}") for p in (25, 50, 75, 95)])


@register("m_mad_global", "SELECT round(mad(value), 6) AS v_mad FROM events")
def m_mad_global(spark, sf):
    return r6(execute(t(spark, sf, "events"), aggs(v_mad=M.median_absolute_deviation("value"))))
