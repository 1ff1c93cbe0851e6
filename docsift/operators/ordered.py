"""Positions and running sums along an order, computed by many tasks.

A window with an ORDER BY but no (or a coarse) PARTITION BY sends every row
of a partition to one task. Here the rows are range-partitioned on
``(partition_by, order)`` instead, so one group spans many slices:

1. range partitioning; the slice id (``spark_partition_id``) is stored with
   the rows by a reliable checkpoint, so the slice totals and the rows always
   agree, also after a task retry;
2. per (group, slice): row count and the sum of each summed column, a table
   of at most groups + slices rows;
3. a window over that small table gives each slice its offsets (everything
   in earlier slices of the same group) and, on request, the group totals;
4. a window inside each (group, slice) adds the local position / running sum
   to the offsets. A window partition is one slice, never a whole group.

Running sums follow SQL window semantics: NULL values are skipped, and the
sum is NULL until the first non-NULL value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage


def join_on_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``b`` to ``a`` on ``keys`` treating NULL keys as equal (a bucket
    may have a NULL key). Key columns come from ``a``."""
    keys = list(keys)
    ren = {k: f"_jk{i}" for i, k in enumerate(keys)}
    b2 = b.select(*[F.col(f"`{c}`").alias(ren.get(c, c)) for c in b.columns])
    cond = reduce(lambda x, y: x & y, [a[f"`{k}`"].eqNullSafe(b2[ren[k]]) for k in keys])
    return a.join(b2, cond, how).drop(*ren.values())


def _add(off: Column, local: Column) -> Column:
    return F.when(off.isNull(), local).when(local.isNull(), off).otherwise(off + local)


def positions(df: DataFrame, partition_by: Sequence[str], order: Sequence[Column],
              sums: Mapping[str, Column] | None = None, position: str | None = "_pos",
              totals: bool = False, slices: int | None = None) -> DataFrame:
    """Add ``position`` (0-based row number within ``partition_by`` in
    ``order``; the order must be unique within a group for positions to be
    deterministic) and, for each ``name -> column`` in ``sums``, the inclusive
    running sum ``name``. ``totals=True`` also adds ``<name>_total`` (and
    ``_n`` for the row count): the whole group's sum.

    ``slices`` fixes the number of range partitions; by default it is
    ``spark.sql.shuffle.partitions`` and AQE may merge small neighbouring
    slices (their ranges stay contiguous, so the result is the same)."""
    pb = list(partition_by)
    sums = dict(sums or {})
    vals = {f"_v{i}": c for i, c in enumerate(sums.values())}
    src = df.withColumns(vals) if vals else df
    range_cols = [*[F.col(f"`{k}`") for k in pb], *order]
    ranged = src.repartitionByRange(slices, *range_cols) if slices else src.repartitionByRange(*range_cols)
    ranged = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id()))

    per = ranged.groupBy(*pb, "_pid").agg(F.count(F.lit(1)).alias("_cnt"),
                                           *[F.sum(v).alias(f"_s{v}") for v in vals])
    grp = Window.partitionBy(*pb)  # rows of the small slice table only
    earlier = grp.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    cols = [*pb, "_pid", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)).alias("_ocnt")]
    cols += [F.sum(f"_s{v}").over(earlier).alias(f"_o{v}") for v in vals]
    if totals:
        cols.append(F.sum("_cnt").over(grp).alias("_n"))
        cols += [F.sum(f"_s{v}").over(grp).alias(f"{name}_total") for v, name in zip(vals, sums)]
    offsets = per.select(*cols)

    if pb:
        joined = join_on_keys(ranged, offsets, [*pb, "_pid"], how="inner")
    else:
        # one row per slice: bounded by the number of partitions
        joined = ranged.join(F.broadcast(offsets), "_pid")
    local = Window.partitionBy(*pb, "_pid").orderBy(*order)
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {}
    if position:
        out[position] = F.col("_ocnt") + F.row_number().over(local) - 1
    # each window expression once; offsets are added in the next projection
    out.update({f"_l{v}": F.sum(v).over(running) for v in vals})
    res = joined.withColumns(out)
    res = res.withColumns({name: _add(F.col(f"_o{v}"), F.col(f"_l{v}")) for v, name in zip(vals, sums)})
    return res.drop("_pid", "_ocnt", *vals, *[f"_o{v}" for v in vals], *[f"_l{v}" for v in vals])


#: Slices of a group in the first round of :func:`top_n_per_group`.
SLICES = 64


def _unhashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_unhashable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _unhashable(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))


def top_n_per_group(df: DataFrame, partition_by: Sequence[str], order: Sequence[Column], n: int,
                    skip: int = 0, rank: str | None = None) -> DataFrame:
    """Rows at positions ``[skip, skip + n)`` of each group in ``order`` (which
    must be unique within a group); ``rank`` names an optional 1-based rank
    column.

    Two rounds: first the rows of a group are dealt out to :data:`SLICES`
    slices by a hash, and each slice keeps its first ``skip + n``; then the
    slices of a group are ranked together. A hot group is ranked by that many
    tasks, and the last round of a group reads ``SLICES * (skip + n)`` rows at
    most, however many tasks there were."""
    pb = list(partition_by)
    last = skip + n
    names = [f.name for f in df.schema.fields if not _unhashable(f.dataType)]
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names]), F.lit(SLICES)) if names else F.lit(0)
    first = Window.partitionBy(*pb, "_slice").orderBy(*order)
    out = df.withColumn("_slice", deal)
    out = out.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= last)
    w = (Window.partitionBy(*pb) if pb else Window.partitionBy(F.lit(0))).orderBy(*order)
    out = out.drop("_slice").withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= last)
    if skip:
        out = out.filter(F.col("_rn") > skip)
    if rank:
        return out.withColumnRenamed("_rn", rank)
    return out.drop("_rn")
