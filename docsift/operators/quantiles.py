"""Exact, interpolated quantiles per group that stay distributed when one
group holds a large share of all rows.

Spark's ``percentile`` / ``median`` aggregates merge every distinct value of a
group inside one task. Here a group is split by value range instead:

1. ``(keys, value) -> count``: duplicates are combined map-side.
2. Running counts along the value order, per group, computed over range
   slices of the group (:func:`docsift.operators.ordered.positions`): every
   distinct value gets its rank interval ``[start, end)`` and the group its
   size, and no task ever holds a whole group.
3. Only the rows holding a wanted rank survive (two per fraction and group);
   a partial aggregate per group picks them and interpolates.

Interpolation: position ``f * (n - 1)``; value at ``floor`` plus the fraction
of the way to the value at ``ceil`` (the usual continuous quantile).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import as_col
from .ordered import positions


def value_counts(df: DataFrame, keys: Sequence[str], value, weight=None) -> DataFrame:
    """``(keys, _x, _c)``: each distinct non-null, non-NaN value of a group
    with its number of rows (or its summed ``weight``), combined map-side."""
    x = as_col(value).cast("double")
    c = F.lit(1) if weight is None else as_col(weight)
    vals = df.select(*[F.col(f"`{k}`") for k in keys], x.alias("_x"), c.alias("_w")).filter(
        F.col("_x").isNotNull() & ~F.isnan("_x"))
    return vals.groupBy(*keys, "_x").agg(F.sum("_w").cast("long").alias("_c"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value, fractions: Sequence[float],
                    names: Sequence[str] | None = None, slices: int | None = None,
                    weight=None, distinct: bool = False) -> DataFrame:
    """One row per group (``keys``) with non-null values, one column per
    fraction (``names``, default ``_q0, _q1, ...``). ``weight``: an integer
    multiplicity per row (a pre-counted table); ``distinct=True`` says each
    (keys, value) already occurs once (the output of :func:`value_counts`),
    which saves the counting shuffle; ``slices``: number of range partitions
    (see :func:`docsift.operators.ordered.positions`)."""
    keys = list(keys)
    fr = [float(f) for f in fractions]
    names = list(names) if names is not None else [f"_q{i}" for i in range(len(fr))]
    if distinct:
        counted = df.select(*[F.col(f"`{k}`") for k in keys], as_col(value).cast("double").alias("_x"),
                            (F.lit(1) if weight is None else as_col(weight)).cast("long").alias("_c")).filter(
            F.col("_x").isNotNull() & ~F.isnan("_x"))
    else:
        counted = value_counts(df, keys, value, weight)
    # running count of values up to and including each distinct value, and
    # the group size, computed over range slices of each group
    ranked = positions(counted, keys, [F.col("_x").asc()], sums={"_end": F.col("_c")},
                       position=None, totals=True, slices=slices)
    ranked = ranked.withColumn("_start", F.col("_end") - F.col("_c")).withColumnRenamed("_end_total", "_size")

    def holds(rank: Column) -> Column:
        return (F.col("_start") <= rank) & (rank < F.col("_end"))

    pos = [F.lit(f) * (F.col("_size") - 1) for f in fr]
    lo = [F.floor(p) for p in pos]
    hi = [F.ceil(p) for p in pos]
    wanted = reduce(lambda a, b: a | b, [holds(r) for r in lo + hi])
    picked = ranked.filter(wanted).groupBy(*keys).agg(
        F.first("_size").alias("_size"),
        *[F.max(F.when(holds(r), F.col("_x"))).alias(f"_lo{i}") for i, r in enumerate(lo)],
        *[F.max(F.when(holds(r), F.col("_x"))).alias(f"_hi{i}") for i, r in enumerate(hi)])
    out = []
    for i, f in enumerate(fr):
        p = F.lit(f) * (F.col("_size") - 1)
        frac = p - F.floor(p)
        out.append((F.col(f"_lo{i}") + frac * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(names[i]))
    return picked.select(*keys, *out)


def check_fractions(fractions: Sequence[float]) -> None:
    for f in fractions:
        if not (0.0 <= f <= 1.0) or math.isnan(f):
            raise ValueError(f"quantile fraction {f} is outside [0, 1]")
