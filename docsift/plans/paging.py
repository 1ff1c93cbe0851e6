"""Reading a sorted result page by page, with a cursor that can be resumed.

A cursor names the table's version and the sort keys of the last row that was
returned, ending with the id, which is unique. The next page is "rows after
that tuple" as a condition, so its first key reaches the scan and a page costs
a top-k of what is left, not a sort of everything before it. Nothing is kept
between pages: a cursor is a short text and may be used by another session,
again, or not at all. The version is pinned, so writes in between do not
move, repeat or hide rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.versioned import BucketedTable
from ..session import cut_lineage
from .search import Request, matching, resolve_fields, sort_column


@dataclass(frozen=True)
class Page:
    """``rows`` in order, and the ``cursor`` of the next page (None: it was
    the last one)."""
    rows: DataFrame
    cursor: str | None


def _after(keys: list[tuple[Column, str, bool]], values: list[Column | None]) -> Column:
    """Rows behind a tuple of values in the order of ``keys`` (column, order,
    whether NULLs come first), spelled out so that the first key's bound can be
    pushed to the scan."""
    def strictly(key: Column, order: str, nulls_first: bool, value: Column | None) -> Column:
        if value is None:
            return key.isNotNull() if nulls_first else F.lit(False)
        beyond = key > value if order == "asc" else key < value
        return beyond if nulls_first else beyond | key.isNull()

    def same(key: Column, value: Column | None) -> Column:
        return key.isNull() if value is None else key == value

    out = F.lit(False)
    for (key, order, nulls_first), value in reversed(list(zip(keys, values))):
        out = strictly(key, order, nulls_first, value) | (same(key, value) & out)
    first, order, nulls_first = keys[0]
    return (strictly(first, order, nulls_first, values[0]) | same(first, values[0])) & out


def read_page(source: BucketedTable | DataFrame, req: Request, size: int, cursor: str | None = None, id_field: str = "id") -> Page:
    """The first ``size`` rows of a sorted query, or those after ``cursor``.

    ``source``: a versioned table (the first page pins its version) or a
    frame that stays as it is, such as a version folder. ``id_field`` must be
    unique and not NULL; it is the last sort key. The query is a query with
    ``sort_on`` and ``select_fields`` as usual, without a size; it must be the
    same for all pages."""
    if req.kind != "query" or req.size is not None or size < 1:
        raise ValueError("a page needs a query without a size, and a size of at least 1")
    said = json.loads(cursor) if cursor else None
    versioned = isinstance(source, BucketedTable)
    if versioned:
        source = source.at(said["version"]) if said and said["version"] != source.version else source
        id_field = source.id_field
    df = matching(source.df if versioned else source, req.where)
    spec = [*req.sort, (id_field, "asc", None, None)]
    order = json.dumps([[str(x) for x in s] for s in spec])
    if said and said["order"] != order:
        raise ValueError("the cursor belongs to a query with another order")
    columns = [sort_column(s, df.schema) for s in spec]
    keys = [(c, s[1], s[2] == "first") for c, s in zip(columns, spec)]
    if said:
        kinds = [f.dataType for f in df.select(*columns).schema.fields]
        df = df.where(_after(keys, [None if v is None else F.lit(v).cast(k) for v, k in zip(said["after"], kinds)]))
    ordered = []
    for c, o, first in keys:
        ordered.append({("asc", True): c.asc_nulls_first, ("asc", False): c.asc_nulls_last,
                        ("desc", True): c.desc_nulls_first, ("desc", False): c.desc_nulls_last}[o, first]())
    chosen = resolve_fields(df.schema, *req.fields) if req.fields is not None else [F.col(f"`{c}`") for c in df.columns]
    place = F.struct(*[c.cast("string").alias(f"k{i}") for i, c in enumerate(columns)])
    rows = df.orderBy(*ordered).limit(size).select(F.struct(*chosen).alias("row"), place.alias("place"))
    # one task has the page in order; the rows and the cursor must agree
    rows = cut_lineage(rows.withColumn("no", F.monotonically_increasing_id()))
    last = rows.agg(F.count(F.lit(1)).alias("n"), F.max_by("place", "no").alias("place")).first()
    out = rows.orderBy("no").select("row.*")
    if last["n"] < size:
        return Page(out, None)
    said = {"version": source.version if versioned else None, "order": order, "after": list(last["place"])}
    return Page(out, json.dumps(said))
