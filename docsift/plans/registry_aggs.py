"""Registered bucket, text and bucket-series queries (see registry.py)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.mapping import lowercase_shadows
from ..operators import bucket_series as S
from ..operators import buckets as B
from ..operators import metrics as M
from ..operators import text as X
from ..operators.postings import PostingsIndex
from ..session import scratch_path
from .registry import docs_with_labels, r6, register, t
from .search import aggs, execute, query, select_fields

TOKENS_SQL = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}]+')"


def toks_sql(c: str) -> str:
    return TOKENS_SQL.format(c=c)


# ================================================================ buckets

@register("b_terms_opts", """
SELECT o_orderpriority AS key, count(*) AS doc_count, round(avg(o_totalprice), 6) AS avg_price
FROM orders WHERE NOT regexp_full_match(o_orderpriority, '5-.*')
GROUP BY 1 HAVING count(*) >= 2000 ORDER BY avg(o_totalprice) DESC, key LIMIT 3
""")
def b_terms_opts(spark, sf):
    spec = B.terms("o_orderpriority", size=3, order=[("avg_price", "desc")], min_doc_count=2000,
                   exclude="5-.*", metrics={"avg_price": M.avg("o_totalprice")})
    return r6(execute(t(spark, sf, "orders"), aggs(x=spec)))


@register("b_terms_missing", """
SELECT coalesce(l.quality, -1) AS key, count(*) AS doc_count FROM documents d LEFT JOIN labels l USING (doc_id)
GROUP BY 1
""")
def b_terms_missing(spark, sf):
    return execute(docs_with_labels(spark, sf), aggs(x=B.terms("quality", size=None, missing=-1)))


@register("b_composite", """
SELECT * FROM (SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS doc_count
               FROM lineitem GROUP BY 1, 2)
WHERE flag > 'A' OR (flag = 'A' AND status > 'O') ORDER BY flag, status LIMIT 3
""")
def b_composite(spark, sf):
    spec = B.composite([("flag", "l_returnflag"), ("status", "l_linestatus")], size=3, after=("A", "O"))
    return execute(t(spark, sf, "lineitem"), aggs(x=spec))


@register("b_histogram", """
WITH b AS (SELECT floor(l_extendedprice / 5000)::BIGINT AS idx, count(*) AS doc_count,
                  avg(l_quantity) AS avg_qty FROM lineitem GROUP BY 1),
r AS (SELECT unnest(generate_series(min(idx), max(idx))) AS idx FROM b)
SELECT r.idx::DOUBLE * 5000 AS key, coalesce(b.doc_count, 0) AS doc_count, round(b.avg_qty, 6) AS avg_qty
FROM r LEFT JOIN b ON b.idx = r.idx
""")
def b_histogram(spark, sf):
    spec = B.histogram("l_extendedprice", 5000, min_doc_count=0, metrics={"avg_qty": M.avg("l_quantity")})
    return r6(execute(t(spark, sf, "lineitem"), aggs(x=spec)))


@register("b_histogram_offset", """
SELECT floor((p_size - 3) / 7.0)::DOUBLE * 7 + 3 AS key, count(*) AS doc_count FROM part GROUP BY 1
""")
def b_histogram_offset(spark, sf):
    return execute(t(spark, sf, "part"), aggs(x=B.histogram("p_size", 7, offset=3)))


@register("b_date_hist_day", """
SELECT date_trunc('day', ts)::TIMESTAMP AS key, count(*) AS doc_count, round(avg(value), 6) AS avg_value
FROM events GROUP BY 1
""")
def b_date_hist_day(spark, sf):
    spec = B.date_histogram("ts", calendar_interval="day", metrics={"avg_value": M.avg("value")})
    return r6(execute(t(spark, sf, "events"), aggs(x=spec)))


@register("b_date_hist_month", """
SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS key, count(*) AS doc_count FROM orders GROUP BY 1
""")
def b_date_hist_month(spark, sf):
    return execute(t(spark, sf, "orders"), aggs(x=B.date_histogram("o_orderdate", calendar_interval="month")))


@register("b_date_hist_fixed", """
WITH b AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS key, count(*) AS doc_count FROM events GROUP BY 1),
r AS (SELECT unnest(generate_series(min(key), max(key), INTERVAL 6 HOUR)) AS key FROM b)
SELECT r.key, coalesce(b.doc_count, 0) AS doc_count FROM r LEFT JOIN b USING (key)
""")
def b_date_hist_fixed(spark, sf):
    spec = B.date_histogram("ts", fixed_interval="6 hours", min_doc_count=0)
    return execute(t(spark, sf, "events"), aggs(x=spec))


@register("b_date_hist_week", """
WITH b AS (SELECT date_trunc('week', o_orderdate)::TIMESTAMP AS key, count(*) AS doc_count FROM orders GROUP BY 1),
r AS (SELECT unnest(generate_series(min(key), max(key), INTERVAL 7 DAY)) AS key FROM b)
SELECT r.key, coalesce(b.doc_count, 0) AS doc_count FROM r LEFT JOIN b USING (key)
""")
def b_date_hist_week(spark, sf):
    spec = B.date_histogram("o_orderdate", calendar_interval="week", min_doc_count=0)
    return execute(t(spark, sf, "orders"), aggs(x=spec))


@register("b_date_hist_quarter", """
SELECT date_trunc('quarter', o_orderdate)::TIMESTAMP AS key, count(*) AS doc_count,
       round(sum(o_totalprice), 6) AS revenue FROM orders GROUP BY 1
""")
def b_date_hist_quarter(spark, sf):
    spec = B.date_histogram("o_orderdate", calendar_interval="quarter", metrics={"revenue": M.sum_("o_totalprice")})
    return r6(execute(t(spark, sf, "orders"), aggs(x=spec)))


_RANGES = [("cheap", None, 10000.0), ("mid", 5000.0, 30000.0), ("high", 30000.0, None), ("none", 1e9, None)]


@register("b_range", """
WITH spec(key, lo, hi) AS (VALUES ('cheap', NULL, 10000.0), ('mid', 5000.0, 30000.0),
                                  ('high', 30000.0, NULL), ('none', 1e9, NULL))
SELECT s.key, s.lo::DOUBLE AS "from", s.hi::DOUBLE AS "to", count(l.l_orderkey) AS doc_count,
       round(avg(l.l_quantity), 6) AS avg_qty
FROM spec s LEFT JOIN lineitem l
  ON (s.lo IS NULL OR l.l_extendedprice >= s.lo) AND (s.hi IS NULL OR l.l_extendedprice < s.hi)
GROUP BY 1, 2, 3
""")
def b_range(spark, sf):
    spec = B.range_("l_extendedprice", _RANGES, metrics={"avg_qty": M.avg("l_quantity")})
    return r6(execute(t(spark, sf, "lineitem"), aggs(x=spec)))


@register("b_date_range", """
WITH spec(key, lo, hi) AS (VALUES ('before_1997', NULL, TIMESTAMP '1997-01-01'),
                                  ('1996_1999', TIMESTAMP '1996-01-01', TIMESTAMP '2000-01-01'),
                                  ('from_2000', TIMESTAMP '2000-01-01', NULL))
SELECT s.key, s.lo AS "from", s.hi AS "to", count(o.o_orderkey) AS doc_count
FROM spec s LEFT JOIN orders o
  ON (s.lo IS NULL OR o.o_orderdate >= s.lo) AND (s.hi IS NULL OR o.o_orderdate < s.hi)
GROUP BY 1, 2, 3
""")
def b_date_range(spark, sf):
    spec = B.date_range("o_orderdate", [("before_1997", None, dt.datetime(1997, 1, 1)),
                                        ("1996_1999", dt.datetime(1996, 1, 1), dt.datetime(2000, 1, 1)),
                                        ("from_2000", dt.datetime(2000, 1, 1), None)])
    return execute(t(spark, sf, "orders"), aggs(x=spec))


def _event_filters():
    return {"clicks": P.term("event_type", "click"),
            "big": P.range_("value", gte=50),
            "early": P.range_("ts", lt=dt.datetime(2024, 1, 10))}


@register("b_filters", """
SELECT 'clicks' AS key, count(*) AS doc_count, round(avg(value), 6) AS avg_value FROM events WHERE event_type = 'click'
UNION ALL SELECT 'big', count(*), round(avg(value), 6) FROM events WHERE value >= 50
UNION ALL SELECT 'early', count(*), round(avg(value), 6) FROM events WHERE ts < TIMESTAMP '2024-01-10'
UNION ALL SELECT 'rest', count(*), round(avg(value), 6) FROM events
  WHERE NOT (event_type = 'click' OR value >= 50 OR ts < TIMESTAMP '2024-01-10')
""")
def b_filters(spark, sf):
    spec = B.filters(_event_filters(), other_bucket_key="rest", metrics={"avg_value": M.avg("value")})
    return r6(execute(t(spark, sf, "events"), aggs(x=spec)))


@register("b_adjacency", """
SELECT * FROM (
  SELECT 'big' AS key, count(*) AS doc_count FROM events WHERE value >= 50
  UNION ALL SELECT 'big&clicks', count(*) FROM events WHERE value >= 50 AND event_type = 'click'
  UNION ALL SELECT 'big&early', count(*) FROM events WHERE value >= 50 AND ts < TIMESTAMP '2024-01-10'
  UNION ALL SELECT 'clicks', count(*) FROM events WHERE event_type = 'click'
  UNION ALL SELECT 'clicks&early', count(*) FROM events WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-10'
  UNION ALL SELECT 'early', count(*) FROM events WHERE ts < TIMESTAMP '2024-01-10')
WHERE doc_count > 0
""")
def b_adjacency(spark, sf):
    return execute(t(spark, sf, "events"), aggs(x=B.adjacency_matrix(_event_filters())))


@register("b_missing", """
SELECT count(*) AS doc_count, round(avg(d.n_chars), 6) AS avg_chars
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL
""")
def b_missing(spark, sf):
    spec = B.missing("quality", metrics={"avg_chars": M.avg("n_chars")})
    return r6(execute(docs_with_labels(spark, sf), aggs(x=spec)))


@register("b_global", "SELECT count(*) AS doc_count, round(avg(n_chars), 6) AS avg_chars FROM documents")
def b_global(spark, sf):
    req = query(P.term("lang", "fr")) + aggs(all_docs=B.global_(metrics={"avg_chars": M.avg("n_chars")}),
                                             fr_sources=B.terms("source", size=None))
    return r6(execute(t(spark, sf, "documents"), req)["all_docs"])


@register("b_global_query_side", """
SELECT d.source AS key, count(*) AS doc_count FROM documents d WHERE d.lang = 'fr' GROUP BY 1
""")
def b_global_query_side(spark, sf):
    req = query(P.term("lang", "fr")) + aggs(all_docs=B.global_(metrics={"avg_chars": M.avg("n_chars")}),
                                             fr_sources=B.terms("source", size=None))
    return execute(t(spark, sf, "documents"), req)["fr_sources"]


@register("b_sub", """
WITH leaf AS (SELECT year(o_orderdate)::INTEGER AS year, o_orderpriority AS priority,
                     count(*) AS priority_doc_count, avg(o_totalprice) AS avg_price FROM orders GROUP BY 1, 2),
y AS (SELECT year, sum(priority_doc_count)::BIGINT AS year_doc_count FROM leaf GROUP BY 1
      ORDER BY year_doc_count DESC, year LIMIT 3),
p AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY priority_doc_count DESC, priority) AS r FROM leaf)
SELECT y.year, y.year_doc_count, p.priority, p.priority_doc_count, round(p.avg_price, 6) AS avg_price
FROM y JOIN p USING (year) WHERE p.r <= 2
""")
def b_sub(spark, sf):
    spec = B.sub_terms([("year", F.year("o_orderdate"), 3), ("priority", "o_orderpriority", 2)],
                       metrics={"avg_price": M.avg("o_totalprice")})
    return r6(execute(t(spark, sf, "orders"), aggs(x=spec)))


@register("b_nested", """
SELECT l_returnflag AS key, count(*) AS doc_count, count(DISTINCT l_orderkey) AS parent_count
FROM lineitem GROUP BY 1
""")
def b_nested(spark, sf):
    return B.nested_terms("l_returnflag", "l_orderkey").run(t(spark, sf, "lineitem"))


@register("q_nested", """
SELECT * FROM orders WHERE o_orderkey IN
  (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49 AND l_discount >= 0.09)
""")
def q_nested(spark, sf):
    return P.nested_flat(t(spark, sf, "orders"), t(spark, sf, "lineitem"), "o_orderkey", "l_orderkey",
                         P.range_("l_quantity", gte=49) & P.range_("l_discount", gte=0.09))


@register("q_terms_lookup", """
SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def q_terms_lookup(spark, sf):
    lookup = t(spark, sf, "customer").filter(P.term("c_mktsegment", "BUILDING"))
    return P.terms_lookup(t(spark, sf, "orders"), "o_custkey", lookup, "c_custkey")


@register("mapping_lower", """
SELECT lower(c_mktsegment) AS key, count(*) AS doc_count FROM customer GROUP BY 1
""")
def mapping_lower(spark, sf):
    c = lowercase_shadows(t(spark, sf, "customer"), ["c_mktsegment"])
    return execute(c, aggs(x=B.terms("c_mktsegment_lc", size=None)))


@register("q_term_ci", "SELECT c_custkey FROM customer WHERE lower(c_mktsegment) = 'machinery'")
def q_term_ci(spark, sf):
    return execute(t(spark, sf, "customer"),
                   query(P.term("c_mktsegment", "Machinery", case_insensitive=True)) + select_fields(["c_custkey"]))


# ================================================================ text

@register("token_terms", f"""
SELECT term AS key, count(*) AS doc_count
FROM (SELECT unnest(list_distinct({toks_sql('text')})) AS term FROM documents)
GROUP BY 1 ORDER BY doc_count DESC, key LIMIT 20
""")
def token_terms(spark, sf):
    return X.token_terms(t(spark, sf, "documents"), "text", size=20)


@register("b_rare", f"""
SELECT term AS key, count(*) AS doc_count
FROM (SELECT unnest(list_distinct({toks_sql('text')})) AS term FROM documents)
GROUP BY 1 HAVING count(*) <= 1
""")
def b_rare(spark, sf):
    return X.rare_terms(t(spark, sf, "documents"), "text", max_doc_count=1)


@register("b_significant", f"""
WITH d AS (SELECT lang = 'fr' AS fg, unnest(list_distinct({toks_sql('text')})) AS term FROM documents),
tot AS (SELECT count(*) AS bg_total, sum((lang = 'fr')::BIGINT) AS fg_total FROM documents),
c AS (SELECT term AS key, sum(fg::BIGINT)::BIGINT AS doc_count, count(*) AS bg_count FROM d GROUP BY 1),
s AS (SELECT c.*, ((doc_count / fg_total) - (bg_count / bg_total)) * (doc_count / fg_total)
                  / (bg_count / bg_total) AS score FROM c, tot WHERE doc_count >= 3)
SELECT key, doc_count, bg_count, round(score, 6) AS score FROM s WHERE score > 0
ORDER BY score DESC, key LIMIT 10
""")
def b_significant(spark, sf):
    return r6(X.significant_terms(t(spark, sf, "documents"), "text", P.term("lang", "fr"), size=10, min_doc_count=3))


@register("q_match_or", f"""
SELECT doc_id FROM documents WHERE list_has_any({toks_sql('text')}, ['esat', 'ndat'])
""")
def q_match_or(spark, sf):
    return execute(t(spark, sf, "documents"), query(P.match("text", "Esat ndat")) + select_fields(["doc_id"]))


@register("q_match_and", f"""
SELECT doc_id FROM documents WHERE list_has_all({toks_sql('text')}, ['in', 'the', 'esat'])
""")
def q_match_and(spark, sf):
    return execute(t(spark, sf, "documents"),
                   query(P.match("text", "in the esat", operator="and")) + select_fields(["doc_id"]))


@register("q_match_msm", f"""
SELECT doc_id FROM documents
WHERE len(list_intersect(list_distinct({toks_sql('text')}), ['esat', 'ndat', 'ated', 'atou'])) >= 2
""")
def q_match_msm(spark, sf):
    return execute(t(spark, sf, "documents"),
                   query(P.match("text", "esat ndat ated atou", minimum_should_match=2)) + select_fields(["doc_id"]))


@register("q_phrase", f"""
SELECT doc_id FROM documents
WHERE contains(' ' || array_to_string({toks_sql('text')}, ' ') || ' ', ' of the ')
""")
def q_phrase(spark, sf):
    return execute(t(spark, sf, "documents"), query(P.match_phrase("text", "Of the")) + select_fields(["doc_id"]))


@register("q_multi_match", f"""
SELECT conv_id, turn FROM conversations
WHERE list_has_any({toks_sql('role')}, ['system', 'esat']) OR list_has_any({toks_sql('text')}, ['system', 'esat'])
""")
def q_multi_match(spark, sf):
    return execute(t(spark, sf, "conversations"),
                   query(P.multi_match(["role", "text"], "system esat")) + select_fields(["conv_id", "turn"]))


@register("q_any_field", f"""
SELECT conv_id, turn FROM conversations
WHERE list_has_any({toks_sql('role')}, ['assistant', 'ndat']) OR list_has_any({toks_sql('text')}, ['assistant', 'ndat'])
""")
def q_any_field(spark, sf):
    c = t(spark, sf, "conversations")
    return execute(c, query(P.any_field(c, "assistant ndat")) + select_fields(["conv_id", "turn"]))


def bm25_sql(table: str, id_col: str, text_col: str, words: list[str], k: int) -> str:
    """BM25 written out in SQL (k1=1.2, b=0.75) for the oracle."""
    dfs = ", ".join(f"sum(CASE WHEN list_contains(toks, '{w}') THEN 1 ELSE 0 END) AS df{i}" for i, w in enumerate(words))
    tfs = ", ".join(f"count(*) FILTER (WHERE w = '{w}')::DOUBLE AS tf{i}" for i, w in enumerate(words))
    terms = " + ".join(
        f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * len(toks) / avgdl))"
        for i in range(len(words)))
    return f"""
WITH d AS (SELECT {id_col}, {toks_sql(text_col)} AS toks FROM {table}),
st AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl, {dfs} FROM d),
tf AS (SELECT {id_col}, {tfs} FROM (SELECT {id_col}, unnest(toks) AS w FROM d) GROUP BY 1),
s AS (SELECT {id_col}, {terms} AS score FROM d JOIN tf USING ({id_col}), st)
SELECT {id_col}, round(score, 6) AS score FROM s WHERE score > 0 ORDER BY score DESC, {id_col} LIMIT {k}
"""


_BM25_Q = "esat ndat ated"


@register("q_bm25", bm25_sql("documents", "doc_id", "text", ["esat", "ndat", "ated"], 10))
def q_bm25(spark, sf):
    return r6(X.bm25_top_k(t(spark, sf, "documents"), "text", _BM25_Q, 10, "doc_id"))


@register("q_relevance", f"""
WITH d AS (SELECT doc_id, lang, {toks_sql('text')} AS toks FROM documents),
st AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl,
              sum(CASE WHEN list_contains(toks, 'esat') THEN 1 ELSE 0 END) AS df0,
              sum(CASE WHEN list_contains(toks, 'ndat') THEN 1 ELSE 0 END) AS df1 FROM d),
tf AS (SELECT doc_id, count(*) FILTER (WHERE w = 'esat')::DOUBLE AS tf0,
              count(*) FILTER (WHERE w = 'ndat')::DOUBLE AS tf1
       FROM (SELECT doc_id, unnest(toks) AS w FROM d) GROUP BY 1),
s AS (SELECT d.doc_id,
        ln(1 + (n - df0 + 0.5) / (df0 + 0.5)) * tf0 * 2.2 / (tf0 + 1.2 * (0.25 + 0.75 * len(toks) / avgdl))
      + ln(1 + (n - df1 + 0.5) / (df1 + 0.5)) * tf1 * 2.2 / (tf1 + 1.2 * (0.25 + 0.75 * len(toks) / avgdl)) AS score
      FROM d JOIN tf USING (doc_id), st WHERE d.lang = 'en')
SELECT doc_id, round(score, 6) AS score FROM s ORDER BY score DESC, doc_id LIMIT 10
""")
def q_relevance(spark, sf):
    """A sized query without a sort comes back in relevance order."""
    req = query(P.term("lang", "en"), size=10, rank=("text", "esat ndat", "doc_id")) + select_fields(["doc_id", "score"])
    return r6(execute(t(spark, sf, "documents"), req))


@register("b_sampler", f"""
WITH top AS ({bm25_sql("documents", "doc_id", "text", ["esat", "ndat", "ated"], 50)})
SELECT d.lang AS key, count(*) AS doc_count FROM documents d JOIN top USING (doc_id) GROUP BY 1
""")
def b_sampler(spark, sf):
    docs = X.bm25_scores(t(spark, sf, "documents"), "text", _BM25_Q, materialize=True)
    spec = B.sampler(B.terms("lang", size=None), score="score", shard_size=50, tie_breaker="doc_id", min_score=0.0)
    return execute(docs, aggs(x=spec))


@register("b_sampler_hash", """
SELECT lang AS key, count(*) AS doc_count FROM documents
WHERE ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 10 = 0 GROUP BY 1
""")
def b_sampler_hash(spark, sf):
    spec = B.sampler(B.terms("lang", size=None), hash_field="doc_id", modulus=10)
    return execute(t(spark, sf, "documents"), aggs(x=spec))


_MORE_LIKE = f"""
WITH toks AS (SELECT doc_id, {toks_sql('text')} AS t FROM documents),
n AS (SELECT count(*) AS n FROM documents),
like_tf AS (SELECT term, count(*) AS tf FROM (SELECT unnest(t) AS term FROM toks WHERE doc_id = 1) GROUP BY 1),
dfs AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(t)) AS term FROM toks) GROUP BY 1),
cand AS (SELECT l.term FROM like_tf l JOIN dfs USING (term), n
         WHERE df >= 2 AND df <= 0.5 * n.n ORDER BY tf * ln(n.n / df) DESC, term LIMIT 25),
shared AS (SELECT d.doc_id, count(*) AS shared_terms
           FROM (SELECT doc_id, unnest(list_distinct(t)) AS term FROM toks WHERE doc_id <> 1) d
           JOIN cand USING (term) GROUP BY 1)
SELECT * FROM shared ORDER BY shared_terms DESC, doc_id LIMIT 10
"""


@register("q_more_like", _MORE_LIKE)
def q_more_like(spark, sf):
    return X.more_like_this(t(spark, sf, "documents"), "text", "doc_id", 1, k=10, max_query_terms=25, min_doc_freq=2,
                            max_doc_freq_ratio=0.5)


@register("i_more_like", _MORE_LIKE)
def i_more_like(spark, sf):
    """The same from the liked document's postings."""
    docs = t(spark, sf, "documents")
    index = PostingsIndex.build(docs, scratch_path(spark, "postings"), "text", "doc_id")
    return index.more_like_this(docs, "text", "doc_id", 1, k=10, max_query_terms=25, min_doc_freq=2, max_doc_freq_ratio=0.5)


# ================================================================ bucket series

def _per_day(spark, sf):
    spec = B.date_histogram("ts", calendar_interval="day", metrics={"total": M.sum_("value")})
    return execute(t(spark, sf, "events"), aggs(x=spec))


_DAY_SQL = "WITH b AS (SELECT date_trunc('day', ts)::TIMESTAMP AS key, count(*) AS doc_count, " \
           "sum(value) AS total FROM events GROUP BY 1) "


@register("p_cumsum", _DAY_SQL + """
SELECT key, doc_count, round(total, 6) AS total,
       round(sum(total) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cum FROM b
""")
def p_cumsum(spark, sf):
    return r6(S.cumulative_sum(_per_day(spark, sf), "total", "cum"))


@register("p_derivative", _DAY_SQL + """
SELECT key, doc_count, round(total, 6) AS total, round(total - lag(total) OVER (ORDER BY key), 6) AS d FROM b
""")
def p_derivative(spark, sf):
    return r6(S.derivative(_per_day(spark, sf), "total", "d"))


@register("p_serial_diff", _DAY_SQL + """
SELECT key, doc_count, round(total, 6) AS total, round(total - lag(total, 7) OVER (ORDER BY key), 6) AS d7 FROM b
""")
def p_serial_diff(spark, sf):
    return r6(S.serial_diff(_per_day(spark, sf), "total", "d7", lag=7))


@register("p_moving_avg", _DAY_SQL + """
SELECT key, doc_count, round(total, 6) AS total,
       round(avg(total) OVER (ORDER BY key ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS mov,
       round(stddev_pop(total) OVER (ORDER BY key ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS mov_std
FROM b
""")
def p_moving_avg(spark, sf):
    bt = S.moving_fn(_per_day(spark, sf), "total", "mov", window=3, fn="avg")
    return r6(S.moving_fn(bt, "total", "mov_std", window=3, fn="std"))


@register("p_siblings", _DAY_SQL + """
SELECT round(avg(total), 6) AS s_avg, round(sum(total), 6) AS s_sum, count(total) AS s_count,
       round(min(total), 6) AS s_min, arg_min(key, total) AS s_min_key,
       round(max(total), 6) AS s_max, arg_max(key, total) AS s_max_key,
       round(quantile_cont(total, 0.5), 6) AS s_p50
FROM b
""")
def p_siblings(spark, sf):
    return r6(S.siblings(_per_day(spark, sf), "total", "s"))


@register("p_script", """
SELECT l_returnflag AS key, count(*) AS doc_count, round(sum(l_extendedprice), 6) AS price,
       round(sum(l_quantity), 6) AS qty, round(sum(l_extendedprice) / sum(l_quantity), 6) AS unit_price
FROM lineitem GROUP BY 1
""")
def p_script(spark, sf):
    bt = execute(t(spark, sf, "lineitem"), aggs(x=B.terms("l_returnflag", size=None, metrics={
        "price": M.sum_("l_extendedprice"), "qty": M.sum_("l_quantity")})))
    return r6(S.bucket_script(bt, "unit_price", F.col("price") / F.col("qty")))


@register("p_selector", """
SELECT o_custkey AS key, count(*) AS doc_count FROM orders GROUP BY 1 HAVING count(*) >= 15
""")
def p_selector(spark, sf):
    bt = execute(t(spark, sf, "orders"), aggs(x=B.terms("o_custkey", size=None)))
    return S.bucket_selector(bt, F.col("doc_count") >= 15)


@register("p_bucket_sort", """
SELECT key, doc_count, avg_price FROM (
  SELECT o_orderpriority AS key, count(*) AS doc_count, round(avg(o_totalprice), 6) AS avg_price,
         row_number() OVER (ORDER BY avg(o_totalprice) DESC, o_orderpriority) AS pos
  FROM orders GROUP BY 1) WHERE pos > 1 AND pos <= 3
""")
def p_bucket_sort(spark, sf):
    bt = execute(t(spark, sf, "orders"), aggs(x=B.terms("o_orderpriority", size=None, metrics={
        "avg_price": M.avg("o_totalprice")})))
    return r6(S.bucket_sort(bt, [F.col("avg_price").desc(), F.col("key").asc()], from_=1, size=2))


@register("p_bucket_sort_nested", """
WITH leaf AS (SELECT o_orderstatus AS status, o_orderpriority AS key, count(*) AS doc_count FROM orders GROUP BY 1, 2)
SELECT status, key, doc_count FROM (
  SELECT *, row_number() OVER (PARTITION BY status ORDER BY doc_count DESC, key) AS pos FROM leaf) WHERE pos <= 2
""")
def p_bucket_sort_nested(spark, sf):
    bt = execute(t(spark, sf, "orders"), aggs(x=B.composite([("status", "o_orderstatus"), ("key", "o_orderpriority")],
                                                           size=None)))
    return S.bucket_sort(bt, [F.col("doc_count").desc(), F.col("key").asc()], size=2, partition_by=["status"])
