"""Pipeline aggregations: functions over a bucket table (the output of a
bucket aggregation), ordered by its key.

Parent pipelines (cumulative sum, derivative, serial diff, moving function,
bucket sort) need each bucket's position along the key order, within its
parent (``partition_by``, the parent bucket path of nested buckets) or over
the whole table. A plain ordered window would hand a whole parent, or the
whole bucket table, to one task; a terms aggregation on a high-cardinality
field can have billions of buckets. Positions and running sums therefore come
from range slices (:mod:`docsift.operators.ordered`), and looking back or
ahead ``n`` buckets is a window over blocks of positions that borrow ``n``
rows from their neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import positions, top_n_per_group
from .quantiles import exact_quantiles


def _order(key: str) -> list[Column]:
    return [F.col(f"`{key}`").asc()]


def cumulative_sum(bt: DataFrame, metric: str, name: str, key: str = "key",
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """Running sum of ``metric`` in key order (per parent with ``partition_by``)."""
    return positions(bt, partition_by, _order(key), sums={name: F.col(metric)}, position=None)


# Rows per block for look-back / look-ahead windows: a block is ranked by one
# task, together with the few rows it borrows from its neighbours.
BLOCK_ROWS = 4096


def _blocked(pos: DataFrame, before: int, after: int) -> DataFrame:
    """Cut each parent's positions into blocks of ``BLOCK_ROWS`` and copy the
    ``before`` last rows of a block into the next block, and the ``after``
    first rows into the previous one (``_own`` marks the original). A window
    partitioned by (parent, block) with a frame reaching at most ``before``
    rows back and ``after`` rows ahead then sees exactly the rows a window
    over the whole parent would; each row is copied at most twice."""
    size = max(BLOCK_ROWS, before, after, 1)
    blk = F.expr(f"_pos div {size}")              # integral: exact for any position
    off = F.col("_pos") - blk * size
    own = F.struct(blk.alias("b"), F.lit(True).alias("o"))
    targets = [own]
    if before:
        targets.append(F.when(off >= size - before, F.struct((blk + 1).alias("b"), F.lit(False).alias("o"))))
    if after:
        targets.append(F.when(off < after, F.struct((blk - 1).alias("b"), F.lit(False).alias("o"))))
    copies = F.filter(F.array(*targets), lambda x: x.isNotNull()) if len(targets) > 1 else F.array(own)
    out = pos.withColumn("_t", F.explode(copies))
    return out.withColumns({"_blk": F.col("_t.b"), "_own": F.col("_t.o")}).drop("_t")


def _block_window(partition_by: Sequence[str]):
    return Window.partitionBy(*partition_by, "_blk").orderBy("_pos")


def derivative(bt: DataFrame, metric: str, name: str, key: str = "key",
               partition_by: Sequence[str] = ()) -> DataFrame:
    """Difference to the previous bucket; NULL for the first bucket."""
    return serial_diff(bt, metric, name, 1, key, partition_by)


def serial_diff(bt: DataFrame, metric: str, name: str, lag: int = 1, key: str = "key",
                partition_by: Sequence[str] = ()) -> DataFrame:
    """Difference to the bucket ``lag`` positions earlier; NULL before that.
    A ``lag`` over blocks of positions (each block borrowing the ``lag`` rows
    before it), so no task holds a whole parent."""
    pos = positions(bt, partition_by, _order(key))
    blocks = _blocked(pos, max(lag, 0), max(-lag, 0))
    prev = F.lag(metric, lag).over(_block_window(partition_by))
    out = blocks.withColumn(name, F.col(metric) - prev).filter(F.col("_own"))
    return out.drop("_pos", "_blk", "_own")


_MOVING = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "std": F.stddev_pop}


def moving_fn(bt: DataFrame, metric: str, name: str, window: int, fn: str = "avg",
              shift: int = 0, key: str = "key", partition_by: Sequence[str] = ()) -> DataFrame:
    """Function of the ``window`` previous buckets (current excluded when
    ``shift=0``; ``shift=1`` includes it). NULL when the window is empty.

    A row frame over blocks of positions: each block borrows the rows its
    first (last) buckets look back (ahead) to from the neighbouring block, so
    the frame is exact and no task sees more than one block."""
    if window < 1:
        raise ValueError("moving_fn needs window >= 1")
    lo, hi = -window + shift, -1 + shift          # frame of position t: rows t+lo .. t+hi
    pos = positions(bt, partition_by, _order(key))
    blocks = _blocked(pos, max(-lo, 0), max(hi, 0))
    frame = _block_window(partition_by).rowsBetween(lo, hi)
    out = blocks.withColumn(name, _MOVING[fn](metric).over(frame)).filter(F.col("_own"))
    return out.drop("_pos", "_blk", "_own")


def bucket_script(bt: DataFrame, name: str, expr: Column | str) -> DataFrame:
    """A new per-bucket value computed from the bucket's metrics."""
    return bt.withColumn(name, F.expr(expr) if isinstance(expr, str) else expr)


def bucket_selector(bt: DataFrame, cond: Column | str) -> DataFrame:
    """Keep buckets for which the condition holds (NULL = dropped)."""
    c = F.expr(cond) if isinstance(cond, str) else cond
    return bt.filter(F.coalesce(c, F.lit(False)))


def bucket_sort(bt: DataFrame, sort: Sequence[Column], from_: int = 0, size: int | None = None,
                partition_by: Sequence[str] = ()) -> DataFrame:
    """Sort buckets and keep positions [from_, from_+size), per parent when
    ``partition_by`` is given. ``sort`` must end in a unique key.

    Without parents and with a size this is a top-k (each task keeps
    ``from_ + size`` rows); per parent it is :func:`top_n_per_group`; without
    a size, positions come from range slices (:func:`positions`). No task
    holds all buckets of a parent."""
    if size is not None:
        if not partition_by:
            return bt.orderBy(*sort).limit(from_ + size).offset(from_)
        return top_n_per_group(bt, partition_by, list(sort), size, skip=from_)
    return positions(bt, partition_by, list(sort)).filter(F.col("_pos") >= from_).drop("_pos")


def sibling(bt: DataFrame, metric: str, name: str, kind: str, key: str = "key",
            percents: Sequence[float] = (50,)) -> DataFrame:
    """Sibling pipelines: one row over all buckets.

    kind: avg | sum | min | max | stats | percentiles. ``min``/``max`` also
    return the key of the extreme bucket (smallest key on ties)."""
    m = F.col(metric)
    if kind in ("avg", "sum"):
        return bt.agg((F.avg(m) if kind == "avg" else F.sum(m)).alias(name))
    if kind in ("min", "max"):
        best = F.min(m) if kind == "min" else F.max(m)
        rank = m if kind == "min" else -m
        return bt.agg(best.alias(name), F.min_by(F.col(key), _ranked(m, rank, key)).alias(f"{name}_key"))
    if kind == "stats":
        return bt.agg(F.count(m).alias(f"{name}_count"), F.min(m).alias(f"{name}_min"),
                      F.max(m).alias(f"{name}_max"), F.avg(m).alias(f"{name}_avg"),
                      F.sum(m).alias(f"{name}_sum"))
    if kind == "percentiles":
        return _bucket_percentiles(bt, metric, name, percents)
    raise ValueError(f"unknown sibling pipeline {kind!r}")


def _ranked(m, rank, key: str):
    """Order of the buckets that have a metric (others take no part)."""
    return F.when(m.isNotNull(), F.struct(rank, F.col(key)))


def siblings(bt: DataFrame, metric: str, name: str, key: str = "key",
             percents: Sequence[float] = (50,)) -> DataFrame:
    """All sibling pipelines in one aggregate over the bucket table: avg, sum,
    min/max (with the key of the extreme bucket, smallest key on ties),
    count and percentiles of ``metric`` across buckets."""
    m = F.col(metric)
    exprs = [F.avg(m).alias(f"{name}_avg"), F.sum(m).alias(f"{name}_sum"), F.count(m).alias(f"{name}_count"),
             F.min(m).alias(f"{name}_min"), F.min_by(F.col(key), _ranked(m, m, key)).alias(f"{name}_min_key"),
             F.max(m).alias(f"{name}_max"), F.min_by(F.col(key), _ranked(m, -m, key)).alias(f"{name}_max_key")]
    out = bt.agg(*exprs)
    if not percents:
        return out
    pct = _bucket_percentiles(bt, metric, name, percents)
    return out.withColumn("_g", F.lit(0)).join(F.broadcast(pct.withColumn("_g", F.lit(0))), "_g", "left").drop("_g")


def _bucket_percentiles(bt: DataFrame, metric: str, name: str, percents: Sequence[float]) -> DataFrame:
    """Exact percentiles of a metric across all buckets, one row; range-split
    (:func:`exact_quantiles`) so a large bucket table is not ranked by one task."""
    names = [f"{name}_p{p:g}".replace(".", "_") for p in percents]
    # without keys the last step is a global aggregate: exactly one row, NULLs
    # when no bucket has a value
    return exact_quantiles(bt, [], metric, [p / 100.0 for p in percents], names=names)
