"""Reading documents: opening a table as a resource, JSON columns to tables,
flattening nested objects, concatenating pages by field name, schema inference."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage


def load(spark: SparkSession, source, fmt: str = "parquet") -> DataFrame:
    """``source`` may be a DataFrame, a catalog table name or a path."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, str) and ("/" in source or source.endswith(f".{fmt}")):
        return spark.read.format(fmt).load(source)
    return spark.table(source)


def json_table(df: DataFrame, column: str, schema: T.StructType | str,
               keep: Sequence[str] = (), malformed: str = "fail") -> DataFrame:
    """Parse a JSON text column with a declared schema and expand its fields
    into columns, next to the ``keep`` columns. A text that is no JSON object,
    or holds a value of another type than declared, fails the job; with
    ``malformed="null"`` what cannot be read is NULL. To set such documents
    aside instead, see :func:`typed_documents`."""
    if malformed not in ("fail", "null"):
        raise ValueError(f"malformed must be fail or null, got {malformed!r}")
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if malformed == "null":
        return df.select(*keep, F.from_json(F.col(column), schema).alias("_doc")).select(*keep, "_doc.*")
    text = F.col(column)
    whole = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(text, whole, {"columnNameOfCorruptRecord": "_corrupt_record"})
    none = F.lit(None).cast(schema)
    # an array would be read as its first object, other values as NULL
    broken = parsed["_corrupt_record"].isNotNull() | ~F.ltrim(text).startswith("{")
    fail = F.raise_error(F.concat(F.lit("malformed document: "), F.substring(text, 1, 200))).cast(schema)
    doc = F.when(text.isNull(), none).when(broken, fail).otherwise(F.struct(*[parsed[f.name].alias(f.name) for f in schema.fields]))
    return df.select(*keep, doc.alias("_doc")).select(*keep, "_doc.*")


def hits_to_table(df: DataFrame, column: str, source_schema: T.StructType | str,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Search replies stored as JSON text -> one row per hit with the hit's
    ``_id`` and the fields of its ``_source``. A reply with no hits gives no
    rows; a malformed or truncated reply, or one without a list of hits (an
    error reply), fails the job."""
    if isinstance(source_schema, str):
        source_schema = T._parse_datatype_string(source_schema)
    hit = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_source", source_schema)])
    reply = T.StructType([T.StructField("hits", T.StructType([T.StructField("hits", T.ArrayType(hit))]))])
    whole = T.StructType([*reply.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(F.col(column), whole, {"columnNameOfCorruptRecord": "_corrupt_record"})
    fail = lambda why: F.raise_error(F.concat(F.lit(why), F.substring(F.col(column), 1, 200))).cast(T.ArrayType(hit))
    hits = F.coalesce(parsed["hits"]["hits"], fail("reply without hits: "))
    checked = F.when(F.col(column).isNotNull(),
                     F.when(parsed["_corrupt_record"].isNotNull(), fail("malformed reply: ")).otherwise(hits))
    return (df.select(*keep, F.explode(checked).alias("_hit"))
              .select(*keep, F.col("_hit._id").alias("_id"), "_hit._source.*"))


def read_search_replies(spark: SparkSession, path: str, source_schema: T.StructType | str,
                        whole_files: bool = False) -> DataFrame:
    """Saved search replies under ``path``, one JSON reply per line, or with
    ``whole_files`` one (perhaps pretty-printed) reply per file -> one row per
    hit (``_id`` and the ``_source`` fields). Files are parsed by the scan
    tasks; nothing passes through the driver."""
    return hits_to_table(spark.read.text(path, wholetext=whole_files), "value", source_schema)


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Expand nested structs into top-level columns named ``parent<sep>child``.
    Arrays stay arrays. Raises when two flattened names collide."""
    cols = []

    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name])
        else:
            ref = F.col(path[0])
            for p in path[1:]:
                ref = ref.getField(p)
            cols.append((sep.join(path), ref))

    for f in df.schema.fields:
        walk(f.dataType, [f.name])
    names = [n for n, _ in cols]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"flattened names collide: {sorted(dup)}")
    return df.select(*[c.alias(n) for n, c in cols])


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by field name; a field absent from a page is NULL
    there. A field of different kinds (say number and text) in any two pages
    raises, naming it."""
    seen: dict[str, T.StructField] = {}
    for page in pages:
        require_same_kinds(T.StructType(list(seen.values())), page.schema)
        for f in page.schema.fields:
            if f.name not in seen or isinstance(seen[f.name].dataType, T.NullType):
                seen[f.name] = f
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def kind_of(dtype: T.DataType) -> str:
    """Kind of a type: numbers of any width are one kind."""
    if isinstance(dtype, T.NumericType):
        return "number"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    return {T.ArrayType: "array", T.StructType: "object", T.MapType: "object"}.get(type(dtype), dtype.simpleString())


def require_same_kinds(a: DataFrame | T.StructType, b: DataFrame | T.StructType) -> None:
    """Raise, naming the fields, when a common field holds different kinds."""
    a, b = (x if isinstance(x, T.StructType) else x.schema for x in (a, b))
    both = {f.name: f.dataType for f in a.fields}
    bad = [f"{f.name}: {both[f.name].simpleString()} and {f.dataType.simpleString()}" for f in b.fields
           if f.name in both and kind_of(f.dataType) != kind_of(both[f.name])
           and not isinstance(f.dataType, T.NullType) and not isinstance(both[f.name], T.NullType)]
    if bad:
        raise TypeError("fields with conflicting types: " + "; ".join(bad))


def infer_json_fields(df: DataFrame, column: str, keep_conflicts: bool = True) -> DataFrame:
    """Infer the fields of a JSON text column: one row per top-level field
    with its merged type and the number of distinct kinds seen (numbers of
    any width are one kind, JSON null is none).

    Runs as a distributed aggregate (partial per task, merged per field), so
    no document goes to the driver. ``n_types > 1`` flags a conflict (one
    field seen with several types), which a typed table must refuse.
    """
    exploded = df.select(F.explode(F.from_json(F.col(column), "map<string,variant>")).alias("key", "value"))
    seen = F.schema_of_variant("value")
    number = seen.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)")
    kind = F.when(number, "number").when(seen != "VOID", F.regexp_extract(seen, "^[A-Z]+", 0))
    out = (exploded.select("key", "value", kind.alias("kind")).groupBy(F.col("key").alias("field"))
                   .agg(F.count_distinct("kind").alias("n_types"),
                        F.lower(F.expr("schema_of_variant_agg(value)")).alias("type"),
                        F.count("*").alias("n_docs")))
    if not keep_conflicts:
        out = out.filter(F.col("n_types") <= 1)
    return out


def _kind_of_value(value: Column) -> Column:
    """Kind of a JSON value; NULL for null."""
    seen = F.schema_of_variant(value)
    number = seen.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)")
    return F.when(number, "number").when(seen != "VOID", F.lower(F.regexp_extract(seen, "^[A-Z]+", 0)))


@dataclass(frozen=True)
class TypedDocuments:
    """``rows``: a column for each field; ``rejected``: the documents that are
    not among them, as text, with a ``reason``; ``types``: each field's type."""
    rows: DataFrame
    rejected: DataFrame
    types: dict[str, str]


def typed_documents(df: DataFrame, column: str, keep: Sequence[str] = ()) -> TypedDocuments:
    """A typed table from JSON documents whose fields are not known before.

    A field's kind is the one that most documents give it (ties: the first by
    name); numbers of any width are one kind, and its type is the least one
    that holds all values of that kind. Every document is either a row or set
    aside with a reason: ``no document`` (NULL), ``malformed``, ``not an
    object``, or ``conflict: ...`` with the first field (by name) that is of
    another kind. So rows and rejected documents add up to the input.

    Two aggregates over the fields, with partial sums in each task; the driver
    gets the fields' names, kinds and types, as the table's schema needs. The
    parsed documents are written once to the checkpoint folder."""
    text = F.col(f"`{column}`").cast("string")
    kept = [F.col(f"`{c}`") for c in keep]
    doc = F.try_parse_json(text)
    parsed = df.select(*kept, text.alias("_text"), doc.isNull().alias("_broken"), F.try_variant_get(doc, "$", "map<string,variant>").alias("_fields"))
    parsed = cut_lineage(parsed.withColumn("_text", F.col("_text")))
    plain = F.when(F.col("_text").isNull(), "no document").when(F.col("_broken"), "malformed").when(F.col("_fields").isNull(), "not an object")
    each = parsed.where(plain.isNull()).select(F.explode("_fields").alias("field", "value")).withColumn("kind", _kind_of_value(F.col("value")))
    seen = each.groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n"), F.expr("schema_of_variant_agg(value)").alias("type")).collect()
    best: dict[str, tuple] = {}
    kinds: dict[str, set] = {}
    for r in seen:
        best.setdefault(r["field"], (0, "", "STRING"))
        if r["kind"] is not None:
            kinds.setdefault(r["field"], set()).add(r["kind"])
            best[r["field"]] = min(best[r["field"]], (-r["n"], r["kind"], r["type"]))
    mixed = {f: best[f][1] for f, k in kinds.items() if len(k) > 1}
    reason = plain
    if mixed:
        own = F.create_map(*[F.lit(x) for pair in sorted(mixed.items()) for x in pair])
        wrong = F.filter(F.array_sort(F.map_keys("_fields")), lambda f: F.coalesce(
            _kind_of_value(F.element_at("_fields", f)) != F.element_at(own, f), F.lit(False)))
        first = F.get(wrong, 0)
        conflict = F.concat(F.lit("conflict: "), first, F.lit(" is "), _kind_of_value(F.element_at("_fields", first)),
                            F.lit(", elsewhere "), F.element_at(own, first))
        reason = plain.when(F.size(wrong) > 0, conflict)
    parsed = parsed.withColumn("_reason", reason)
    types = {f: t.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING") for f, (_, _, t) in sorted(best.items())}
    clash = [n for n in types if [x.lower() for x in [*keep, *types]].count(n.lower()) > 1]
    if clash:
        raise ValueError(f"fields that only differ in case, or are kept columns: {sorted(clash)}")
    values = [F.element_at("_fields", F.lit(f)).cast(t).alias(f) for f, t in types.items()]
    return TypedDocuments(parsed.where("_reason IS NULL").select(*kept, *values),
                          parsed.where("_reason IS NOT NULL").select(*kept, F.col("_text").alias("document"), F.col("_reason").alias("reason")), types)


def require_rows(df: DataFrame, message: str = "query returned no rows") -> DataFrame:
    """Raise when the result is empty (looks at one row only)."""
    if not df.limit(1).take(1):
        raise LookupError(message)
    return df


def require_consistent_types(fields: DataFrame) -> DataFrame:
    """Raise when :func:`infer_json_fields` saw a field with several types (a
    typed table cannot hold it). The driver gets their number and the first
    one by name; ``fields`` holds them all."""
    bad = fields.filter(F.col("n_types") > 1).agg(F.count("*").alias("n"), F.min("field").alias("first")).first()
    if bad["n"]:
        raise TypeError(f"{bad['n']} fields with conflicting types, the first is {bad['first']}")
    return fields
