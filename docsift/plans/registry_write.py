"""Registered table-maintenance and source queries (see registry.py)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.mapping import clean_field_names, parse_timestamp
from ..operators import write as W
from ..operators.versioned import BucketedTable
from ..session import scratch_path
from ..sources import documents as D
from .paging import read_page
from .registry import r6, register, t
from .search import query, select_fields, sort_on

# ================================================================ writes


def _changed_orders(spark, sf):
    """A batch derived from orders: two versions of every pending order (the
    later one must win) and new documents built from the finished ones."""
    o = t(spark, sf, "orders")
    pending = o.filter(P.term("o_orderstatus", "P"))
    v1 = pending.withColumn("o_totalprice", F.col("o_totalprice") * 1.1).withColumn("seq", F.lit(1))
    v2 = pending.withColumn("o_totalprice", F.col("o_totalprice") * 1.2).withColumn("seq", F.lit(2))
    fresh = (o.filter(P.term("o_orderstatus", "F"))
              .withColumn("o_orderkey", F.col("o_orderkey") + F.lit(1_000_000_000))
              .withColumn("o_orderstatus", F.lit("N")).withColumn("seq", F.lit(1)))
    batch = v1.unionByName(v2).unionByName(fresh)
    # upper-case names as a client might send them; cleaning lower-cases them
    return batch.toDF(*[c.upper() for c in batch.columns])


_UPSERT_SQL = """
WITH new AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 1.2 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT o_orderkey + 1000000000, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) UNION ALL SELECT * FROM new)
"""


@register("upsert_by_id", _UPSERT_SQL)
def upsert_by_id(spark, sf):
    out = W.upsert(t(spark, sf, "orders"), _changed_orders(spark, sf), id_field="o_orderkey", order_field="seq")
    return r6(out)


@register("assign_ids", """
SELECT c_name, c_nationkey, c_acctbal, c_mktsegment,
       sha256(to_json({'c_name': c_name, 'c_nationkey': c_nationkey, 'c_acctbal': c_acctbal,
                       'c_mktsegment': c_mktsegment})::VARCHAR) AS id
FROM customer
""")
def assign_ids(spark, sf):
    return W.assign_ids(t(spark, sf, "customer").drop("c_custkey"), "id", method="content")


@register("clean_names", "SELECT c_custkey AS c_custkey, c_name AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def clean_names(spark, sf):
    c = t(spark, sf, "customer")
    raw = c.toDF("C.CustKey", "C.Name", "C_NationKey", "c.acctbal", "C.MktSegment")
    return clean_field_names(raw)


@register("mapping_timestamp", """
SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('millisecond', ts)
                                 WHEN 'view' THEN date_trunc('day', ts)::TIMESTAMP
                                 ELSE date_trunc('millisecond', ts) END AS parsed
FROM events
""")
def mapping_timestamp(spark, sf):
    e = t(spark, sf, "events")
    raw = (F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
            .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd"))
            .otherwise(F.unix_millis(F.col("ts").cast("timestamp")).cast("string")))
    return e.select("event_id", raw.alias("raw")).select("event_id", parse_timestamp("raw").alias("parsed"))


@register("infer_json", """
SELECT k AS field, count(DISTINCT ty) AS n_types, min(ty) AS type, count(*) AS n_docs FROM (
  SELECT k, CASE json_type(props, '$.' || k) WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint'
              WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
              ELSE lower(json_type(props, '$.' || k)) END AS ty
  FROM (SELECT props, unnest(json_keys(props)) AS k FROM events))
GROUP BY 1
""")
def infer_json(spark, sf):
    return D.infer_json_fields(t(spark, sf, "events"), "props")


@register("delete_type", "SELECT * FROM events WHERE event_type <> 'error'")
def delete_type(spark, sf):
    return W.delete_type(t(spark, sf, "events"), "event_type", "error")


@register("delete_ids", "SELECT * FROM orders WHERE o_orderkey NOT IN (1, 2, 3, 999999999)")
def delete_ids(spark, sf):
    return W.delete_ids(t(spark, sf, "orders"), [1, 2, 3, 999999999], id_field="o_orderkey")


@register("delete_ids_table", """
SELECT * FROM orders WHERE o_orderkey NOT IN
  (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45)
""")
def delete_ids_table(spark, sf):
    ids = (t(spark, sf, "lineitem").filter(P.term("l_returnflag", "R") & P.range_("l_quantity", gte=45))
           .select(F.col("l_orderkey").alias("o_orderkey")))
    return W.delete_ids(t(spark, sf, "orders"), ids, id_field="o_orderkey")


@register("collect_ids", "SELECT o_orderkey FROM orders WHERE o_totalprice > 300000")
def collect_ids(spark, sf):
    return W.collect_ids(t(spark, sf, "orders"), P.range_("o_totalprice", gt=300000), id_field="o_orderkey")


def _feed(spark, sf):
    return _feed_of(t(spark, sf, "events"))


def _feed_of(e):
    """An action feed derived from events: one action per event on customer
    ``user_id + 1400`` (some ids exist, some do not), ordered by event_id.
    Works on the batch table and on a stream of it."""
    action = (F.when(F.col("event_type") == "view", "index").when(F.col("event_type") == "click", "update")
               .when(F.col("event_type") == "purchase", "create").when(F.col("event_type") == "error", "delete")
               .otherwise("update"))
    full = action.isin("index", "create")
    return e.select(
        (F.col("user_id") + 1400).alias("c_custkey"), F.col("event_id").alias("seq"), action.alias("action"),
        F.when(full, F.concat(F.lit("U"), F.col("event_id").cast("string"))).alias("c_name"),
        F.when(full, F.length("props")).alias("c_nationkey"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("c_acctbal"),
        F.when(F.col("event_type") == "signup", "SIGNUP").when(F.col("event_type") == "view", "VIEWED")
         .when(F.col("event_type") == "purchase", "BUYER").alias("c_mktsegment"))


_FEED_SQL = """
feed AS (
  SELECT user_id + 1400 AS id, event_id AS seq,
         CASE event_type WHEN 'view' THEN 'index' WHEN 'click' THEN 'update' WHEN 'purchase' THEN 'create'
                         WHEN 'error' THEN 'delete' ELSE 'update' END AS action,
         CASE WHEN event_type IN ('view', 'purchase') THEN 'U' || event_id::VARCHAR END AS c_name,
         CASE WHEN event_type IN ('view', 'purchase') THEN length(props)::INTEGER END AS c_nationkey,
         CASE WHEN event_type <> 'signup' THEN value END AS c_acctbal,
         CASE event_type WHEN 'signup' THEN 'SIGNUP' WHEN 'view' THEN 'VIEWED' WHEN 'purchase' THEN 'BUYER' END
           AS c_mktsegment,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
  FROM events)"""


# The oracle folds the actions one by one with a recursive CTE (an
# independent formulation of the same semantics).
_FOLD_SQL = "WITH RECURSIVE " + _FEED_SQL + """,
ids AS (SELECT DISTINCT id FROM feed),
fold(id, rn, present, c_name, c_nationkey, c_acctbal, c_mktsegment) AS (
  SELECT i.id, 0::BIGINT, c.c_custkey IS NOT NULL, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
  FROM ids i LEFT JOIN customer c ON c.c_custkey = i.id
  UNION ALL
  SELECT f.id, f.rn,
    CASE f.action WHEN 'index' THEN true WHEN 'delete' THEN false WHEN 'create' THEN true ELSE s.present END,
    CASE WHEN f.action = 'index' THEN f.c_name WHEN f.action = 'delete' THEN NULL
         WHEN f.action = 'create' THEN (CASE WHEN s.present THEN s.c_name ELSE f.c_name END)
         ELSE (CASE WHEN s.present THEN coalesce(f.c_name, s.c_name) END) END,
    CASE WHEN f.action = 'index' THEN f.c_nationkey WHEN f.action = 'delete' THEN NULL
         WHEN f.action = 'create' THEN (CASE WHEN s.present THEN s.c_nationkey ELSE f.c_nationkey END)
         ELSE (CASE WHEN s.present THEN coalesce(f.c_nationkey, s.c_nationkey) END) END,
    CASE WHEN f.action = 'index' THEN f.c_acctbal WHEN f.action = 'delete' THEN NULL
         WHEN f.action = 'create' THEN (CASE WHEN s.present THEN s.c_acctbal ELSE f.c_acctbal END)
         ELSE (CASE WHEN s.present THEN coalesce(f.c_acctbal, s.c_acctbal) END) END,
    CASE WHEN f.action = 'index' THEN f.c_mktsegment WHEN f.action = 'delete' THEN NULL
         WHEN f.action = 'create' THEN (CASE WHEN s.present THEN s.c_mktsegment ELSE f.c_mktsegment END)
         ELSE (CASE WHEN s.present THEN coalesce(f.c_mktsegment, s.c_mktsegment) END) END
  FROM fold s JOIN feed f ON f.id = s.id AND f.rn = s.rn + 1),
last AS (SELECT * FROM fold QUALIFY rn = max(rn) OVER (PARTITION BY id))
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT id FROM ids)
UNION ALL
SELECT id AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM last WHERE present
"""


@register("apply_actions", _FOLD_SQL)
def apply_actions(spark, sf):
    return W.apply_actions(t(spark, sf, "customer"), _feed(spark, sf), "c_custkey", "seq", "action",
                           ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


@register("stream_indexed_view", _FOLD_SQL)
def stream_indexed_view(spark, sf):
    """The same action feed arriving as a stream: Structured Streaming reads
    the events table as a file stream and appends the actions exactly once to
    an action log (its checkpoint under spark.checkpoint.dir); the table is
    the customer base merged with the log on read."""
    from ..session import scratch_path
    from ..streaming import indexing as S

    events = t(spark, sf, "events")
    stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
                   .option("recursiveFileLookup", "false").parquet(sf))
    work = scratch_path(spark, "indexed")
    q = S.append_actions(_feed_of(stream), f"{work}/log", f"{work}/checkpoint")
    q.awaitTermination()  # the trigger ends when the input is drained
    if q.exception() is not None:
        raise q.exception()
    return S.current_view(spark, t(spark, sf, "customer"), f"{work}/log", "c_custkey",
                          ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


_ORDER_SQL = ("{'o_orderkey': o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus, "
              "'o_orderpriority': o_orderpriority}")


def _bulk_orders(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@register("bulk_lines", f"""
SELECT o_orderkey::VARCHAR AS _id, 0 AS line_no,
       to_json({{'index': {{'_index': 'orders', '_id': o_orderkey::VARCHAR}}}})::VARCHAR AS line FROM orders
UNION ALL
SELECT o_orderkey::VARCHAR, 1, to_json({_ORDER_SQL})::VARCHAR FROM orders
""")
def bulk_lines(spark, sf):
    return W.bulk_lines(_bulk_orders(spark, sf), "orders", id_field="o_orderkey")


@register("bulk_delete_lines", """
SELECT o_orderkey::VARCHAR AS _id, to_json({'delete': {'_index': 'orders', '_id': o_orderkey::VARCHAR}})::VARCHAR AS line
FROM orders
""")
def bulk_delete_lines(spark, sf):
    return (W.bulk_pairs(_bulk_orders(spark, sf), "orders", id_field="o_orderkey", action="delete")
            .select("_id", F.col("action_line").alias("line")))


# ================================================================ sources

@register("json_table", "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_table(spark, sf):
    return D.json_table(t(spark, sf, "events"), "props", "k BIGINT", keep=["event_id"])


@register("search_reply_table", "SELECT event_id::VARCHAR AS _id, event_type, value FROM events")
def search_reply_table(spark, sf):
    e = t(spark, sf, "events")
    hit = F.struct(F.col("event_id").cast("string").alias("_id"),
                   F.struct("event_type", "value").alias("_source"))
    replies = e.select(F.to_json(F.struct(F.struct(F.array(hit).alias("hits")).alias("hits"))).alias("reply"))
    return D.hits_to_table(replies, "reply", "event_type STRING, value DOUBLE")


@register("flatten_struct", """
SELECT o_orderkey, o_custkey AS info_o_custkey, o_orderstatus AS info_o_orderstatus,
       o_totalprice AS info_money_o_totalprice, o_orderdate AS info_money_o_orderdate FROM orders
""")
def flatten_struct(spark, sf):
    o = t(spark, sf, "orders")
    nested = o.select("o_orderkey", F.struct("o_custkey", "o_orderstatus",
                                             F.struct("o_totalprice", "o_orderdate").alias("money")).alias("info"))
    return D.flatten(nested)


@register("union_pages", """
SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL AS o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""")
def union_pages(spark, sf):
    o = t(spark, sf, "orders")
    cut = dt.datetime(1998, 1, 1)
    first = o.filter(P.range_("o_orderdate", lt=cut))
    second = o.filter(P.range_("o_orderdate", gte=cut)).drop("o_orderpriority")
    return D.union_pages([first, second])


@register("require_rows", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def require_rows(spark, sf):
    return D.require_rows(t(spark, sf, "orders").filter(P.term("o_orderstatus", "F")))


# ================================================================ tables that change by buckets

def _table(spark, sf, name, id_field):
    return BucketedTable.create(t(spark, sf, name), scratch_path(spark, name), id_field, buckets=8)


@register("upsert_by_bucket", _UPSERT_SQL)
def upsert_by_bucket(spark, sf):
    """The touched buckets are written anew, the others are shared with the
    version before."""
    return r6(_table(spark, sf, "orders", "o_orderkey").upsert(_changed_orders(spark, sf), "seq").df)


@register("delete_by_bucket", "SELECT * FROM orders WHERE o_orderkey NOT IN (1, 2, 3, 999999999)")
def delete_by_bucket(spark, sf):
    return _table(spark, sf, "orders", "o_orderkey").delete([1, 2, 3, 999999999]).df


@register("actions_by_bucket", _FOLD_SQL)
def actions_by_bucket(spark, sf):
    fields = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return _table(spark, sf, "customer", "c_custkey").apply(_feed(spark, sf), seq_field="seq", action_field="action", fields=fields).df


@register("older_version", "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders")
def older_version(spark, sf):
    """A version is read as it was, whatever was written since."""
    first = _table(spark, sf, "orders", "o_orderkey")
    later = first.delete(list(range(100))).upsert(_changed_orders(spark, sf), "seq")
    out = later.at(first.version).df.agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    return out.withColumn("total", F.round("total", 2))


@register("pages_joined", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority, count(*) OVER () AS n FROM orders
           WHERE o_orderkey % 2 = 0)
SELECT o_orderkey, priority, (row_number() OVER (ORDER BY priority DESC NULLS LAST, o_orderkey) - 1) // greatest(n // 3, 1) AS page FROM o
""")
def pages_joined(spark, sf):
    """Page after page of a sorted query, with ties and NULLs, and a write in
    between that the pinned version does not see."""
    o = t(spark, sf, "orders").withColumn("priority", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    table = BucketedTable.create(o, scratch_path(spark, "orders"), "o_orderkey", buckets=8)
    req = query(F.col("o_orderkey") % 2 == 0) + (sort_on(("priority", "desc")) + select_fields(["o_orderkey", "priority"]))
    size = max(o.where(F.col("o_orderkey") % 2 == 0).count() // 3, 1)
    page = read_page(table, req, size)
    pages, latest = [page.rows], table.delete([2, 4, 6])
    while page.cursor:
        page = read_page(latest, req, size, page.cursor)
        pages.append(page.rows)
    numbered = [p.withColumn("page", F.lit(i).cast("long")) for i, p in enumerate(pages)]
    return D.union_pages(numbered)
