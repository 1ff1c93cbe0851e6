from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name (dots address struct fields) or a Column."""
    return F.col(c) if isinstance(c, str) else c


def null_safe(cond: Column) -> Column:
    """A missing field never matches: NULL becomes FALSE."""
    return F.coalesce(cond, F.lit(False))
