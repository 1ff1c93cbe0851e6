"""Maintaining tables of documents: ids, upsert, action feeds, deletes,
bulk-line export and versioned persistence.

Every operator is a pure ``DataFrame -> DataFrame`` function; persisting the
result is a separate, explicit step (:func:`save_version`) that writes a new
version instead of overwriting the table being read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.mapping import clean_field_names
from ..functions.predicates import not_
from ..session import cut_lineage
from ..sources.documents import require_same_kinds

# The bulk protocol's actions.
ACTIONS = ("index", "create", "update", "delete")


def assign_ids(df: DataFrame, id_field: str = "id", method: str = "unique") -> DataFrame:
    """Give rows without an id one.

    ``unique``: every row its own, also identical rows and rows of different
    calls. The rows are written once to the checkpoint folder, so that their
    ids stay the same after an executor loss. Ids are text, or negative random
    numbers in a column of whole numbers.
    ``content``: SHA-256 of the row's JSON form; identical rows get the same
    id. ``uuid``: random ids (not stable across task retries)."""
    kind = df.schema[id_field].dataType if id_field in df.columns else T.StringType()
    if method == "content":
        new = F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns if c != id_field])), 256)
    elif method == "unique":
        df = cut_lineage(df)
        place = F.concat(F.lit(uuid.uuid4().hex), F.monotonically_increasing_id().cast("string"))
        new = F.sha2(place, 256)
        if isinstance(kind, T.IntegralType):
            return df.withColumn(id_field, F.coalesce(F.col(id_field).cast("bigint"),
                                                      -(F.xxhash64(place).bitwiseAND(F.lit((1 << 62) - 1))) - 1))
    elif method == "uuid":
        new = F.expr("uuid()")
    else:
        raise ValueError(method)
    if id_field in df.columns:
        return df.withColumn(id_field, F.coalesce(F.col(id_field).cast("string"), new))
    return df.withColumn(id_field, new)


def latest_per_id(df: DataFrame, keys: str | Sequence[str], order_field: str | None) -> DataFrame:
    """One row per id (or per tuple of keys): the one with the greatest
    ``order_field``; a row without an order value loses to any row with one.
    Without an order the result fails when ids repeat.

    Uses ``max_by`` over a struct (a declarative aggregate with map-side
    partial aggregation) rather than a window, so an id repeated millions of
    times is reduced inside every task before the shuffle."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in keys])
    if order_field is None:
        packed = df.groupBy(*keys).agg(F.first(row).alias("_r"), F.count(F.lit(1)).alias("_n"))
        repeated = F.raise_error(F.lit("ids repeat in the batch; give an order column to pick the latest"))
        packed = packed.withColumn("_r", F.when(F.col("_n") > 1, repeated.cast(packed.schema["_r"].dataType))
                                   .otherwise(F.col("_r")))
    else:
        known = F.col(order_field).isNotNull()
        packed = df.groupBy(*keys).agg(F.max_by(row, F.struct(known, F.col(order_field))).alias("_r"))
    return packed.select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in df.columns])


def upsert(base: DataFrame, new: DataFrame, id_field: str = "id", order_field: str | None = None,
           clean_names: bool = True, type_field: str | None = None) -> DataFrame:
    """Index rows into a table: a row whose id exists replaces the stored
    document, others are appended; rows without id get one of their own
    (:func:`assign_ids`). With ``type_field`` a document is replaced only by
    one of its type. A common field that holds different kinds raises, and so
    does (when the result is read) an id of the batch that the base holds more
    than once: which of its rows to replace is not defined.

    Plan: latest row per id in the batch, then one full outer join with the
    base on the id (the batch is read once; AQE splits skewed ids; a base
    bucketed on the id is read in place). The check counts the rows of an id
    where the join has them side by side."""
    if clean_names:
        new = clean_field_names(new)
    rest = [f for f in new.columns if f != id_field]
    require_same_kinds(base.drop(id_field), new.select(*rest))
    if id_field not in new.columns or new.schema[id_field].nullable:
        new = assign_ids(new, id_field)
    keys = [id_field] + ([type_field] if type_field else [])
    new = latest_per_id(new, keys, order_field)
    if order_field is not None and order_field not in base.columns:
        new = new.drop(order_field)
    if base.schema[id_field].dataType != new.schema[id_field].dataType:
        whole = all(isinstance(d.schema[id_field].dataType, T.IntegralType) for d in (base, new))
        kind = "bigint" if whole else "string"
        base, new = (d.withColumn(id_field, F.col(id_field).cast(kind)) for d in (base, new))
    packed = lambda d, name: d.select(*keys, F.struct(F.lit(1).alias("_"), *[
        F.col(f"`{c}`") for c in d.columns if c not in keys]).alias(name))
    # the window has the join's partitioning and order: no shuffle or sort of its own
    held = packed(base, "_b").withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    joined = held.join(packed(new, "_n"), keys, "full_outer")
    refused = F.raise_error(F.concat(F.lit("the table holds an id more than once: "), F.col(id_field).cast("string")))
    twice = F.col("_n").isNotNull() & (F.col("_rows") > 1)
    joined = joined.withColumn("_n", F.when(twice, refused.cast(joined.schema["_n"].dataType)).otherwise(F.col("_n")))
    out = []
    for c in [*base.columns, *[c for c in new.columns if c not in base.columns]]:
        if c in keys:
            out.append(F.col(c))
            continue
        kept = F.col("_b")[c] if c in base.columns else F.lit(None)
        came = F.col("_n")[c] if c in new.columns else F.lit(None)
        out.append(F.when(F.col("_n").isNotNull(), came).otherwise(kept).alias(c))
    return joined.select(*out)


def delete_ids(df: DataFrame, ids: Iterable | DataFrame, id_field: str = "id", type_field: str | None = None,
               doc_type=None) -> DataFrame:
    """Remove documents by id; unknown ids are ignored. ``ids`` may be a list
    (numbers or text; text that is no id of the field's type fails) or a
    DataFrame with an ``id_field`` column. With ``type_field`` only documents
    of ``doc_type`` are removed."""
    if isinstance(ids, DataFrame):
        table = ids.select(id_field).distinct()  # pre-aggregated: repeated ids shuffle once
    else:
        text = df.sparkSession.createDataFrame([(str(i),) for i in ids], "_id string")
        table = text.select(F.col("_id").cast(df.schema[id_field].dataType).alias(id_field)).distinct()
    if type_field is None:
        return df.join(table, on=id_field, how="left_anti")
    kind = df.schema[type_field].dataType
    return df.join(table.withColumn(type_field, F.lit(doc_type).cast(kind)), on=[id_field, type_field], how="left_anti")


def delete_type(df: DataFrame, type_field: str, doc_type) -> DataFrame:
    """Remove all documents of one type; schema unchanged; NULL types stay."""
    return df.filter(not_(F.col(type_field) == F.lit(doc_type)))


def collect_ids(df: DataFrame, where: Column | None = None, id_field: str = "id") -> DataFrame:
    out = df.filter(where) if where is not None else df
    return out.select(id_field)


def apply_actions(base: DataFrame, feed: DataFrame, id_field: str, seq_field: str = "seq",
                  action_field: str = "action", fields: Sequence[str] | None = None) -> DataFrame:
    """Apply a feed of bulk actions to a table, in ``seq`` order per id.

    index  -> the document replaces whatever is stored (or is added)
    create -> added only when the id is absent
    update -> non-null fields overwrite the stored ones, only when present
    delete -> removed

    No per-id list is ever built. The effect of a sequence of actions on one
    id depends only on: L = the last index/delete; C1 = the first create after
    L; and, per field, the last non-null update if it comes after L (the last
    one overall is after L or there is none after L). L, the last updates and
    the last create's seq are order-insensitive aggregates (max/max_by) in
    ONE ``groupBy(id)`` with map-side partial aggregation, so an id carrying
    a third of the feed is pre-combined in every task. Only ``create`` rows
    of ids with a create after L are joined back to find C1 (the aggregate is
    checkpointed, so the feed is read twice in all). The result is joined to
    the base with one full outer join on id.

    ``fields`` are the feed's document fields (default: all but id, sequence
    and action). Base columns outside them keep their values until a document
    is replaced; fields the base lacks are added. An unknown action, or an
    action without sequence number or id, fails the job.
    """
    known = (id_field, seq_field, action_field)
    fields = list(fields) if fields is not None else [c for c in feed.columns if c not in known]
    seq, act = F.col(seq_field), F.col(action_field)
    valid = act.isin(*ACTIONS) & seq.isNotNull() & F.col(id_field).isNotNull()
    broken = F.raise_error(F.concat_ws(" ", F.lit("bad action:"), act, F.lit("sequence"), seq.cast("string"), F.lit("id"),
                                       F.col(id_field).cast("string"))).cast("string")
    checked = F.when(F.coalesce(valid, F.lit(False)), act).otherwise(broken).alias(action_field)
    f = feed.select(id_field, seq_field, checked, *fields)
    is_const = act.isin("index", "delete")
    is_create = act == "create"
    aggs = [F.max(F.when(is_const, seq)).alias("_l_seq"),
            F.max_by(F.struct(act.alias("_act"), *[F.col(c) for c in fields]), F.when(is_const, seq)).alias("_l"),
            F.max(F.when(is_create, seq)).alias("_c_last")]
    for i, c in enumerate(fields):
        upd = (act == "update") & F.col(c).isNotNull()
        aggs.append(F.max_by(F.struct(seq.alias("s"), F.col(c).alias("v")), F.when(upd, seq)).alias(f"_u{i}"))
    last = cut_lineage(f.groupBy(id_field).agg(*aggs))

    after_l = lambda s: F.col("_l_seq").isNull() | (s > F.col("_l_seq"))
    need = last.filter(F.col("_c_last").isNotNull() & after_l(F.col("_c_last"))).select(id_field, "_l_seq")
    creates = (f.filter(is_create).select(id_field, seq_field, *fields)
                .join(need, on=id_field, how="inner").filter(after_l(seq)))
    first = creates.groupBy(id_field).agg(F.min(seq).alias("_c_seq"),
                                          F.min_by(F.struct(*[F.col(c) for c in fields]), seq).alias("_c"))
    per_id = last.join(first, on=id_field, how="left")

    stored = [c for c in base.columns if c != id_field]
    b = base.select(id_field, F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in stored]).alias("_b"),
                    F.lit(True).alias("_in_base"))
    j = b.join(per_id, on=id_field, how="full_outer")
    has_l = F.col("_l_seq").isNotNull()
    start_present = F.when(has_l, F.col("_l._act") == "index").otherwise(F.coalesce(F.col("_in_base"), F.lit(False)))
    present = F.when(start_present, F.lit(True)).otherwise(F.col("_c_seq").isNotNull())
    out_cols = {c: F.when(start_present & ~has_l, F.col("_b")[c]).alias(c) for c in stored}
    for i, c in enumerate(fields):
        start_v = F.when(has_l, F.col("_l")[c]).otherwise(F.col("_b")[c] if c in stored else F.lit(None))
        u = F.col(f"_u{i}")
        u_ok = u.isNotNull() & after_l(u["s"])
        if_present = F.when(u_ok, u["v"]).otherwise(start_v)
        if_created = F.when(u_ok & (u["s"] > F.col("_c_seq")), u["v"]).otherwise(F.col("_c")[c])
        out_cols[c] = F.when(start_present, if_present).otherwise(if_created).alias(c)
    return j.filter(present).select(id_field, *out_cols.values())


def bulk_lines(df: DataFrame, index: str, id_field: str | None = None, action: str = "index",
               doc_type: str | None = None) -> DataFrame:
    """Export as bulk JSON lines: per document an action line followed by the
    document line. Returns (``_id``, ``line_no`` 0/1, ``line``). To write a
    file use :func:`write_bulk_file`, which keeps each pair in one row and
    needs no sort."""
    pairs = bulk_pairs(df, index, id_field, action, doc_type)
    return pairs.select("_id", F.posexplode(F.array("action_line", "document_line")).alias("line_no", "line"))


def bulk_pairs(df: DataFrame, index: str, id_field: str | None = None, action: str = "index",
               doc_type: str | None = None) -> DataFrame:
    if action not in ACTIONS:
        raise ValueError(f"action must be one of {ACTIONS}")
    meta = [F.lit(index).alias("_index")]
    if doc_type is not None:
        meta.append(F.lit(doc_type).alias("_type"))
    if id_field is not None:
        meta.append(F.col(id_field).cast("string").alias("_id"))
    action_line = F.to_json(F.struct(F.struct(*meta).alias(action)))
    doc_line = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    rid = F.col(id_field).cast("string") if id_field else F.sha2(doc_line, 256)
    out = df.select(rid.alias("_id"), action_line.alias("action_line"),
                    (doc_line if action != "delete" else F.lit(None).cast("string")).alias("document_line"))
    return out


def write_bulk_file(df: DataFrame, path: str, index: str, id_field: str | None = None,
                    action: str = "index", doc_type: str | None = None) -> str:
    """Write bulk JSON lines as text files: each document becomes one output
    record holding its action line and document line joined by a newline, so
    the pair stays adjacent in whatever file and order its task writes. No
    shuffle or global sort; one file per partition. ``delete`` actions have
    no document line. Refuses to overwrite ``path``."""
    pairs = bulk_pairs(df, index, id_field, action, doc_type)
    pairs.select(F.concat_ws("\n", "action_line", "document_line").alias("value")) \
         .write.mode("errorifexists").text(path)
    return path


def save_version(df: DataFrame, base_path: str, version: str, fmt: str = "parquet") -> str:
    """Persist as a new version folder (never overwrite what is being read);
    readers switch by pointing at the new path."""
    path = f"{base_path.rstrip('/')}/v={version}"
    df.write.mode("errorifexists").format(fmt).save(path)
    return path


def save_bucketed_version(df: DataFrame, name: str, version: str, id_field: str = "id",
                          buckets: int | None = None, fmt: str = "parquet") -> str:
    """Persist a table state as catalog table ``<name>__v<version>``,
    bucketed and sorted by ``id_field``, and point view ``name`` at it.

    Upserts, deletes by id and action feeds all join the base on the id.
    With the base bucketed on it, those joins read the base in place (no
    shuffle of the large side); only the batch is shuffled into the buckets.
    ``buckets`` defaults to ``spark.sql.shuffle.partitions``; size it so that
    one bucket file is a few hundred MB. Never overwrites: an existing version
    fails, and readers switch when the view is replaced."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}__v{version}"
    # one task per bucket, so a bucket is one file
    (df.repartition(n, id_field).write.mode("errorifexists").format(fmt).bucketBy(n, id_field).sortBy(id_field)
       .saveAsTable(table))
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")
    return table
