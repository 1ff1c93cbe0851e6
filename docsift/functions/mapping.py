"""Schema-level helpers: field-name cleaning, case-insensitive shadow columns,
multi-format timestamp parsing and declared schemas.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_col

# The three accepted spellings of a timestamp field.
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd")  # plus epoch milliseconds

SHADOW_SUFFIX = "_lc"


def clean_name(name: str) -> str:
    """``.`` is reserved as a path separator, so it becomes ``_``; names are lower-cased."""
    return name.replace(".", "_").lower()


def clean_field_names(df: DataFrame) -> DataFrame:
    """Rename every top-level column with :func:`clean_name`; raise when two
    columns would end up with the same name."""
    new = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both clean to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def lowercase_shadows(df: DataFrame, fields: Iterable[str] | None = None,
                      suffix: str = SHADOW_SUFFIX) -> DataFrame:
    """Add ``<field><suffix> = lower(field)`` for every (or the listed) string
    column. Originals are kept verbatim; predicates and buckets that should be
    case-insensitive use the shadow column."""
    if fields is None:
        fields = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({f + suffix: F.lower(F.col(f)) for f in fields})


def parse_timestamp(c) -> Column:
    """Timestamp from ``yyyy-MM-dd HH:mm:ss.SSS``, ``yyyy-MM-dd`` or epoch
    milliseconds (string or number); NULL when none applies."""
    c = as_col(c)
    s = c.cast("string")
    return F.coalesce(
        F.try_to_timestamp(s, F.lit(TIMESTAMP_FORMATS[0])),
        F.try_to_timestamp(s, F.lit(TIMESTAMP_FORMATS[1])),
        F.when(s.rlike(r"^-?[0-9]+$"), F.timestamp_millis(s.try_cast("bigint"))),
    ).cast("timestamp_ntz")


def map_timestamps(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    return df.withColumns({f: parse_timestamp(f) for f in fields})


def empty_table(spark, schema: T.StructType) -> DataFrame:
    """An empty frame with a declared schema (what an index mapping declares)."""
    return spark.createDataFrame([], schema)


def create_table(spark, name: str, schema: T.StructType, path: str | None = None) -> None:
    """Create an empty, typed table; fails when it already exists."""
    w = empty_table(spark, schema).write.mode("error").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def drop_table(spark, name: str, approve: bool = False) -> None:
    """Drop a whole table; refuses unless ``approve is True``."""
    if approve is not True:
        raise PermissionError("dropping a whole table needs approve=True")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_tables(spark, pattern: str | None = None) -> DataFrame:
    """Tables and views visible in the current catalog, as a DataFrame."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables(pattern=pattern)]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")


def list_fields(df: DataFrame) -> DataFrame:
    """Top-level field names (sorted) with their Spark types."""
    rows = sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    return df.sparkSession.createDataFrame(rows, "field string, type string")
