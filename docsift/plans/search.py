"""Search requests: query, sort, field selection, size and aggregations,
composed with ``+`` and executed against a resource as one lazy plan.

    res = Resource(spark, "events", doc_type="click", type_field="event_type")
    res.search(query(P.range_("value", gte=10)) + aggs(by_type=B.terms(...)))

A request becomes ``filter -> orderBy -> select -> limit`` (documents) or
``filter -> groupBy/agg`` (aggregations). Catalyst pushes the filter and the
column pruning into the Parquet scan; ``orderBy().limit(k)`` plans as a
distributed top-k (TakeOrderedAndProject). A sort is never emitted under an
aggregation.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import predicates
from ..functions.common import as_col
from ..operators.buckets import BucketAgg, Results
from ..operators.metrics import Metric, aggregate


# ---------------------------------------------------------------- requests

@dataclass(frozen=True)
class Request:
    kind: str                    # 'query' | 'partial' | 'sort' | 'fields' | 'aggs'
    where: object = None         # Column, or a function of predicates.on(frame)
    sort: tuple = ()
    fields: tuple | None = None  # (includes, excludes)
    size: int | None = None      # None = all documents
    aggs: Mapping | None = None
    rank: tuple | None = None    # (text field, query text, id field): relevance order

    def __add__(self, other: "Request") -> "Request":
        return combine(self, other)


def query(where=None, size: int | None = None, rank: tuple | None = None) -> Request:
    """``size=None`` returns all matching documents, ``size=N`` the first N.

    ``rank=(text_field, text, id_field)`` gives an unsorted query a relevance
    order: documents come back by BM25 score of ``text`` (ties by id), with
    the score in a ``score`` column. An explicit sort takes precedence."""
    if size is not None and size < 0:
        raise ValueError("size must be >= 0")
    return Request("query", where=where, size=size, rank=rank)


def sort_on(*keys) -> Request:
    """Keys: a field name (ascending), or (field, 'asc'|'desc'), or
    (field, order, missing 'first'|'last', mode 'min'|'max' for arrays)."""
    norm = []
    for k in keys:
        if isinstance(k, (str, Column)):
            k = (k, "asc")
        k = tuple(k) + (None,) * (4 - len(k))
        f, order, missing, mode = k
        if order not in ("asc", "desc"):
            raise ValueError(f"order must be asc or desc, got {order!r}")
        norm.append((f, order, missing, mode))
    if not norm:
        raise ValueError("sort_on needs at least one key")
    return Request("sort", sort=tuple(norm))


def select_fields(includes: Sequence[str] = ("*",), excludes: Sequence[str] = ()) -> Request:
    return Request("fields", fields=(tuple(includes), tuple(excludes)))


def aggs(**named) -> Request:
    """Named bucket or metric aggregations."""
    if not named:
        raise ValueError("aggs needs at least one named aggregation")
    for n, a in named.items():
        if not isinstance(a, (BucketAgg, Metric)):
            raise TypeError(f"{n}: not an aggregation spec")
    return Request("aggs", aggs=dict(named))


def combine(x: Request, y: Request) -> Request:
    """Allowed pairs (either order): query+sort, query+fields, fields+sort
    (a partial query without size), query+partial, query+aggs. Everything
    else raises, including two full queries (combine predicates with ``&``)."""
    kinds = {x.kind, y.kind}
    pick = lambda k: x if x.kind == k else y
    if kinds == {"query", "sort"}:
        q, s = pick("query"), pick("sort")
        if q.sort:
            raise ValueError("query is already sorted")
        return replace(q, sort=s.sort)
    if kinds == {"query", "fields"}:
        q, f = pick("query"), pick("fields")
        if q.fields is not None:
            raise ValueError("query already selects fields")
        return replace(q, fields=f.fields)
    if kinds == {"fields", "sort"}:
        s, f = pick("sort"), pick("fields")
        return Request("partial", sort=s.sort, fields=f.fields)
    if kinds == {"query", "partial"}:
        q, p = pick("query"), pick("partial")
        if q.sort or q.fields is not None:
            raise ValueError("query already has sort or field selection")
        return replace(q, sort=p.sort, fields=p.fields)
    if kinds == {"query", "aggs"}:
        q, a = pick("query"), pick("aggs")
        return Request("aggs", where=q.where, aggs=a.aggs)
    raise TypeError(f"cannot combine {x.kind} with {y.kind}")


# ---------------------------------------------------------------- execution

def sort_column(spec, schema: T.StructType) -> Column:
    """What a sort key compares: the field, or of an array the element that
    decides the order."""
    f, order, _, mode = spec
    c = as_col(f)
    if mode is None and isinstance(f, str) and isinstance(type_at(schema, f), T.ArrayType):
        mode = "min" if order == "asc" else "max"
    return F.array_min(c) if mode == "min" else F.array_max(c) if mode == "max" else c


def _sort_col(spec, schema: T.StructType) -> Column:
    _, order, missing, _ = spec
    c = sort_column(spec, schema)
    if missing is None:
        missing = "last"
    if order == "asc":
        return c.asc_nulls_first() if missing == "first" else c.asc_nulls_last()
    return c.desc_nulls_first() if missing == "first" else c.desc_nulls_last()


def _hashable(dt: T.DataType) -> bool:
    """Types ``xxhash64`` accepts (no maps or variants, also inside nesting)."""
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return _hashable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_hashable(f.dataType) for f in dt.fields)
    return True


def _row_hash(df: DataFrame, names: Sequence[str]) -> Column:
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name in names and _hashable(f.dataType)]
    return F.xxhash64(*cols) if cols else F.lit(0)


def type_at(schema: T.DataType, path: str) -> T.DataType | None:
    """Type of a dotted path, through objects and arrays of objects (then an
    array); None if there is no such field."""
    many = False
    for name in path.split("."):
        while isinstance(schema, T.ArrayType):
            schema, many = schema.elementType, True
        if not isinstance(schema, T.StructType) or name not in schema.names:
            return None
        schema = schema[name].dataType
    return T.ArrayType(schema) if many and not isinstance(schema, T.ArrayType) else schema


def matching(df: DataFrame, where) -> DataFrame:
    """Rows that match a condition: a Column, or a function of the frame's
    predicates (:func:`docsift.functions.predicates.on`)."""
    if where is None:
        return df
    return df.filter(where if isinstance(where, Column) else where(predicates.on(df)))


def resolve_fields(schema: T.StructType, includes: Sequence[str], excludes: Sequence[str] = ()) -> list[Column]:
    """Field selection with ``*`` patterns over dotted paths. A struct is kept
    whole when its path matches, or rebuilt with only its matching leaves;
    excludes win over includes; schema order is kept."""

    def matches(path: str, pats) -> bool:
        return any(fnmatch.fnmatchcase(path, p) or (p.endswith(".*") and fnmatch.fnmatchcase(path, p[:-2]))
                   for p in pats)

    def walk(dtype, path: str, ref: Column, above: bool = False):
        """Returns (column or None, whole) where whole = nothing was dropped;
        ``above``: an object that holds this field is included."""
        inc, exc = above or matches(path, includes), matches(path, excludes)
        if exc:
            return None, False
        if isinstance(dtype, T.StructType):
            parts, whole = [], True
            for f in dtype.fields:
                sub, sub_whole = walk(f.dataType, f"{path}.{f.name}", ref.getField(f.name), inc)
                whole = whole and sub_whole
                if sub is not None:
                    parts.append(sub.alias(f.name))
            if inc and whole:
                return ref, True
            return (F.when(ref.isNotNull(), F.struct(*parts)) if parts else None), False
        if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
            # a path inside an array of objects: the same parts of each element
            kept = []

            def element(x):
                sub, whole = walk(dtype.elementType, path, x, inc)
                kept.append((sub is not None, whole))
                return sub if sub is not None else x
            out = F.transform(ref, element)
            some, whole = kept[-1]
            return (ref, True) if inc and whole else (out if some else None, False)
        return (ref, True) if inc else (None, False)

    out = []
    for f in schema.fields:
        c, _ = walk(f.dataType, f.name, F.col(f.name))
        if c is not None:
            out.append(c.alias(f.name))
    return out


def run_documents(df: DataFrame, req: Request) -> DataFrame:
    if req.kind == "partial":
        raise ValueError("a sort/field selection alone is not executable; add a query")
    out = matching(df, req.where)
    if req.size == 0:
        return out.limit(0)
    if req.rank is not None and not req.sort:
        from ..operators.text import bm25_scores
        field_, text, id_field = req.rank
        # collection statistics (one row) come from the whole resource, as in
        # a search index; whole rows are ranked, so ids may repeat or be NULL
        out = bm25_scores(out, field_, text, stats_df=df)
        out = out.orderBy(F.col("score").desc(), F.col(id_field).asc_nulls_last())
    chosen = resolve_fields(out.schema, *req.fields) if req.fields is not None else None
    if req.sort:
        cols = [_sort_col(s, out.schema) for s in req.sort]
        if req.size is None:
            # an unsized sort is range-partitioned on its keys, and rows that
            # tie on all of them cannot be split: sorting on a field where one
            # value holds a third of the rows would leave that third to one
            # task. A hash of the returned columns breaks such ties so the range
            # bounds can split them (their relative order is unspecified).
            names = out.columns if chosen is None else out.select(*chosen).columns
            cols.append(_row_hash(out, names).asc())
        out = out.orderBy(*cols)
    if chosen is not None:
        out = out.select(*chosen)
    if req.size is not None:
        out = out.limit(req.size)
    return out


def run_aggs(df: DataFrame, req: Request) -> DataFrame | Mapping[str, DataFrame]:
    """One DataFrame per named aggregation (a mapping when there are several,
    in which each is planned when it is read).
    Metric aggregations listed together are evaluated in one aggregate."""
    filtered = matching(df, req.where)
    metric_specs = {n: a for n, a in req.aggs.items() if isinstance(a, Metric)}
    results: dict[str, DataFrame] = {}
    if metric_specs:
        wide = aggregate(filtered, [], metric_specs, doc_count=None)
        for n in metric_specs:
            # metrics share one aggregate (one scan); beside other
            # aggregations each result holds its own columns only
            results[n] = wide if len(metric_specs) == len(req.aggs) else wide.select(*metric_specs[n].output(n))
    buckets = {n: a for n, a in req.aggs.items() if isinstance(a, BucketAgg)}
    results |= {n: a.run(df) for n, a in buckets.items() if getattr(a, "ignores_query", False)}
    found = Results(filtered, {n: a for n, a in buckets.items() if n not in results}, results)
    if len(req.aggs) == 1 or len(metric_specs) == len(req.aggs):
        return found[next(iter(req.aggs))]
    return found


def execute(df: DataFrame, req: Request):
    if req.kind in ("query", "partial"):
        return run_documents(df, req)
    if req.kind == "aggs":
        return run_aggs(df, req)
    raise TypeError(f"a {req.kind} request alone returns nothing; combine it with a query")


# ---------------------------------------------------------------- resource

@dataclass
class Resource:
    """A table of documents, optionally restricted to one document type."""
    spark: SparkSession
    source: object                 # table name, path, or DataFrame
    doc_type: str | None = None
    type_field: str = "_type"
    fmt: str = "parquet"
    _df: DataFrame | None = field(default=None, repr=False)

    @property
    def all_documents(self) -> DataFrame:
        """Every document of the table, whatever its type."""
        if self._df is None:
            from ..sources.documents import load
            self._df = load(self.spark, self.source, self.fmt)
        return self._df

    @property
    def df(self) -> DataFrame:
        out = self.all_documents
        if self.doc_type is not None:
            out = out.filter(F.col(self.type_field) == F.lit(self.doc_type))
        return out

    def search(self, req: Request):
        return execute(self.df, req)

    def fields(self) -> DataFrame:
        from ..functions.mapping import list_fields
        return list_fields(self.df)

    # -- maintenance: each verb returns the table after the change as a lazy
    # DataFrame; persist it with ``save`` (a new version, never an overwrite
    # of the table being read)

    def index(self, new: DataFrame, id_field: str = "id", order_field: str | None = None) -> DataFrame:
        """Upsert ``new`` by id (rows without an id get one of their own);
        with a document type the new rows carry it and replace documents of
        that type only."""
        from ..functions.mapping import clean_field_names
        from ..operators.write import upsert
        new = clean_field_names(new)
        if self.doc_type is not None:
            new = new.withColumn(self.type_field, F.lit(self.doc_type))
        return upsert(self.all_documents, new, id_field, order_field, clean_names=False,
                      type_field=self.type_field if self.doc_type is not None else None)

    def delete(self, approve: bool = False, ids=None, id_field: str = "id") -> DataFrame | None:
        """``ids=[...]`` (or a DataFrame of ids): remove those documents
        (of the resource's type, if it has one).
        ``approve=True`` with a document type: remove all documents of the
        type (the schema stays). ``approve=True`` without a type: drop the
        catalog table and return None. Anything else is refused."""
        from ..operators.write import delete_ids, delete_type
        if ids is not None:
            return delete_ids(self.all_documents, ids, id_field,
                              *((self.type_field, self.doc_type) if self.doc_type is not None else ()))
        if approve is not True:
            raise PermissionError("deleting a whole table or type needs approve=True (or give ids=)")
        if self.doc_type is not None:
            return delete_type(self.all_documents, self.type_field, self.doc_type)
        if isinstance(self.source, str) and "/" not in self.source:
            from ..functions.mapping import drop_table
            drop_table(self.spark, self.source, approve=True)
            self._df = None
            return None
        raise ValueError("only catalog tables can be dropped; a path-backed table is dropped by removing "
                         "its version folders")

    def create(self, schema: T.StructType, path: str | None = None) -> None:
        """Create the (catalog) table empty with a declared schema; fails when it exists."""
        from ..functions.mapping import create_table
        if not isinstance(self.source, str) or "/" in self.source:
            raise ValueError("create needs a catalog table name")
        create_table(self.spark, self.source, schema, path)
        self._df = None

    def list_tables(self, pattern: str | None = None) -> DataFrame:
        from ..functions.mapping import list_tables
        return list_tables(self.spark, pattern)

    @staticmethod
    def save(df: DataFrame, base_path: str, version: str, fmt: str = "parquet") -> str:
        """Persist a table state as a new version folder; returns its path."""
        from ..operators.write import save_version
        return save_version(df, base_path, version, fmt)

    @staticmethod
    def save_table(df: DataFrame, name: str, version: str, id_field: str = "id",
                   buckets: int | None = None) -> str:
        """Persist a table state as a catalog table bucketed on the id (later
        upserts and deletes read it without a shuffle) and point view
        ``name`` at it; returns the versioned table name."""
        from ..operators.write import save_bucketed_version
        return save_bucketed_version(df, name, version, id_field, buckets)


def search(df: DataFrame, where: Column | None = None, sort: Sequence = (), fields=None,
           size: int | None = None, aggregations: Mapping | None = None):
    """Functional form of a request."""
    if aggregations:
        return execute(df, query(where) + aggs(**aggregations))
    req = query(where, size)
    if sort:
        req = req + sort_on(*sort)
    if fields is not None:
        inc, exc = fields if isinstance(fields, tuple) else (fields, ())
        req = req + select_fields(inc, exc)
    return execute(df, req)
