"""Metric aggregations. Valid globally (no keys) and inside any bucket.

A metric is a small spec object. :func:`aggregate` turns a dict of named
metrics into ONE ``groupBy().agg()`` (a single scan with map-side partial
aggregation, so a hot key is pre-combined on every task before the shuffle).
The few metrics that are not a single aggregate expression (exact percentiles,
median absolute deviation, string entropy) run as separate aggregates on the
same keys and are joined on the reduced bucket table.

Output naming: a single-valued metric ``m`` gives column ``m``; a
multi-valued one gives ``m_<part>`` (e.g. ``m_min``, ``m_p50``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import as_col
from ..functions.predicates import on
from .ordered import join_on_keys, top_n_per_group
from .quantiles import check_fractions, exact_quantiles, value_counts


def _pct_label(p: float) -> str:
    s = f"{p:g}"
    return s.replace(".", "_").replace("-", "m")


class Metric:
    """Base class. ``exprs`` returns aggregate expressions aliased with their
    final (or temporary) names; ``post`` maps temporaries to final columns."""

    def exprs(self, name: str) -> list[Column]:
        raise NotImplementedError

    def post(self, name: str) -> list[Column] | None:
        return None

    def output(self, name: str) -> list[str]:
        return [name]

    special = False

    def partials(self, name: str) -> list[tuple[str, Column, object]] | None:
        """Parts that parents can be made of (:meth:`merged`) from their
        children's: name, aggregate expression, and the function that adds
        parts up. None if the metric cannot be put together."""
        return None

    def merged(self, name: str) -> list[Column]:
        """The metric from its parts."""
        raise NotImplementedError

    def main_exprs(self, name: str) -> list[Column]:
        """Expressions of a special metric that fit the main aggregate."""
        return []

    def only_where(self, cond: Column) -> "Metric | None":
        """The metric over the rows where ``cond`` holds, or None if it
        cannot be had by hiding a field's value elsewhere."""
        if self.special or not hasattr(self, "field"):
            return None
        return replace(self, field=F.when(cond, as_col(self.field)))


def _parts(name: str, c: Column) -> dict[str, tuple]:
    return {"count": (f"_{name}_count", F.count(c), F.sum), "sum": (f"_{name}_sum", F.sum(c), F.sum),
            "min": (f"_{name}_min", F.min(c), F.min), "max": (f"_{name}_max", F.max(c), F.max)}


def _from_parts(name: str, part: str) -> Column:
    if part == "avg":
        return F.try_divide(F.col(f"_{name}_sum"), F.col(f"_{name}_count")).cast("double")
    return F.col(f"_{name}_{part}")


@dataclass
class _Simple(Metric):
    fn: str
    field: object

    def exprs(self, name):
        c = as_col(self.field)
        f = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "value_count": F.count}[self.fn]
        return [f(c).alias(name)]

    def partials(self, name):
        every = _parts(name, as_col(self.field))
        return [every[p] for p in {"avg": ("sum", "count"), "value_count": ("count",)}.get(self.fn, (self.fn,))]

    def merged(self, name):
        return [_from_parts(name, "count" if self.fn == "value_count" else self.fn).alias(name)]


def avg(field) -> Metric:
    return _Simple("avg", field)


def sum_(field) -> Metric:
    return _Simple("sum", field)


def min_(field) -> Metric:
    return _Simple("min", field)


def max_(field) -> Metric:
    return _Simple("max", field)


def value_count(field) -> Metric:
    """Number of non-null values."""
    return _Simple("value_count", field)


@dataclass
class cardinality(Metric):  # noqa: N801
    """Distinct values: exact by default (Spark rewrites it into a two-level
    aggregate shuffled on (key, value), so a hot key is still spread), or a
    HyperLogLog++ estimate with ``approx=True`` (constant memory per group)."""
    field: object
    approx: bool = False
    rsd: float = 0.05

    def exprs(self, name):
        c = as_col(self.field)
        if self.approx:
            return [F.approx_count_distinct(c, self.rsd).alias(name)]
        return [F.count_distinct(c).alias(name)]


@dataclass
class stats(Metric):  # noqa: N801
    field: object

    def exprs(self, name):
        c = as_col(self.field)
        return [F.count(c).alias(f"{name}_count"), F.min(c).alias(f"{name}_min"),
                F.max(c).alias(f"{name}_max"), F.avg(c).alias(f"{name}_avg"),
                F.sum(c).alias(f"{name}_sum")]

    def output(self, name):
        return [f"{name}_{p}" for p in ("count", "min", "max", "avg", "sum")]

    def partials(self, name):
        return list(_parts(name, as_col(self.field)).values())

    def merged(self, name):
        return [_from_parts(name, p).alias(f"{name}_{p}") for p in ("count", "min", "max", "avg", "sum")]


@dataclass
class extended_stats(Metric):  # noqa: N801
    """``stats`` plus sum of squares, population variance / standard deviation
    and the avg ± sigma·std bounds."""
    field: object
    sigma: float = 2.0

    def exprs(self, name):
        c = as_col(self.field)
        wide = c.cast("double")  # squares of whole numbers overflow their type
        sd = F.stddev_pop(wide)
        return [F.count(c).alias(f"{name}_count"), F.min(c).alias(f"{name}_min"),
                F.max(c).alias(f"{name}_max"), F.avg(c).alias(f"{name}_avg"),
                F.sum(c).alias(f"{name}_sum"), F.sum(wide * wide).alias(f"{name}_sum_of_squares"),
                F.var_pop(wide).alias(f"{name}_variance"), sd.alias(f"{name}_std_deviation"),
                (F.avg(c) + F.lit(self.sigma) * sd).alias(f"{name}_std_upper"),
                (F.avg(c) - F.lit(self.sigma) * sd).alias(f"{name}_std_lower")]

    def output(self, name):
        return [f"{name}_{p}" for p in ("count", "min", "max", "avg", "sum", "sum_of_squares",
                                        "variance", "std_deviation", "std_upper", "std_lower")]


@dataclass
class percentiles(Metric):  # noqa: N801
    """Interpolated percentiles (``percents`` in 0..100). Exact by default and
    split by value range, so a hot group is ranked by many tasks
    (:func:`exact_quantiles`). ``approx=True`` uses the bounded-memory
    quantile sketch (``percentile_approx``) in the single aggregate."""
    field: object
    percents: Sequence[float] = (1, 5, 25, 50, 75, 95, 99)
    approx: bool = False
    accuracy: int = 10000
    slices: int | None = None      # range partitions of the exact form (default: shuffle partitions)

    def __post_init__(self):
        check_fractions([p / 100.0 for p in self.percents])

    @property
    def special(self):
        return not self.approx

    def exprs(self, name):
        c = as_col(self.field)
        fr = [p / 100.0 for p in self.percents]
        return [F.percentile_approx(c, fr, self.accuracy).alias(f"_{name}_arr")]

    def post(self, name):
        return [F.col(f"_{name}_arr")[i].alias(f"{name}_p{_pct_label(p)}")
                for i, p in enumerate(self.percents)]

    def compute(self, df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return exact_quantiles(df, keys, self.field, [p / 100.0 for p in self.percents],
                               names=self.output(name), slices=self.slices)

    def output(self, name):
        return [f"{name}_p{_pct_label(p)}" for p in self.percents]


@dataclass
class percentile_ranks(Metric):  # noqa: N801
    """Share (in percent) of non-null values <= each given value."""
    field: object
    values: Sequence[float] = ()

    def exprs(self, name):
        c = as_col(self.field)
        return [(F.avg(F.when(c.isNotNull(), F.when(c <= F.lit(v), 1.0).otherwise(0.0))) * 100.0)
                .alias(f"{name}_{_pct_label(v)}") for v in self.values]

    def output(self, name):
        return [f"{name}_{_pct_label(v)}" for v in self.values]


@dataclass
class weighted_avg(Metric):  # noqa: N801
    """sum(value*weight)/sum(weight) over rows where both are present; NULL
    where the weights add up to 0."""
    value: object
    weight: object

    def exprs(self, name):
        v, w = as_col(self.value).cast("double"), as_col(self.weight).cast("double")
        both = v.isNotNull() & w.isNotNull()
        return [F.try_divide(F.sum(F.when(both, v * w)), F.sum(F.when(both, w))).alias(name)]


@dataclass
class matrix_stats(Metric):  # noqa: N801
    """Count, mean, sample variance per field and sample covariance /
    correlation per pair, over rows where all fields are present. The
    correlation with a field that does not vary is NULL."""
    fields: Sequence[str]

    def _rows(self):
        ok = F.lit(True)
        for f in self.fields:
            ok = ok & as_col(f).isNotNull()
        return ok

    def exprs(self, name):
        ok = self._rows()
        g = lambda f: F.when(ok, as_col(f))
        out = [F.count(F.when(ok, F.lit(1))).alias(f"{name}_count")]
        for f in self.fields:
            out += [F.avg(g(f)).alias(f"{name}_{f}_mean"), F.var_samp(g(f)).alias(f"{name}_{f}_variance")]
        fs = list(self.fields)
        for i in range(len(fs)):
            for j in range(i + 1, len(fs)):
                a, b = fs[i], fs[j]
                out += [F.covar_samp(g(a), g(b)).alias(f"{name}_{a}_{b}_covariance"),
                        F.try_divide(F.covar_pop(g(a), g(b)), F.stddev_pop(g(a)) * F.stddev_pop(g(b)))
                        .alias(f"{name}_{a}_{b}_correlation")]
        return out

    def output(self, name):
        fs = list(self.fields)
        out = [f"{name}_count"]
        for f in fs:
            out += [f"{name}_{f}_mean", f"{name}_{f}_variance"]
        for i, a in enumerate(fs):
            for b in fs[i + 1:]:
                out += [f"{name}_{a}_{b}_covariance", f"{name}_{a}_{b}_correlation"]
        return out



# --- fields with several values ---------------------------------------------

@dataclass
class _ArrayStats(Metric):
    """A plain metric of an array field: each element is a value. Elements are
    reduced inside the document, so the metric stays in the main aggregate."""
    of: Metric
    values: Column

    def exprs(self, name):
        v = F.filter(self.values, lambda x: x.isNotNull())
        double = F.transform(v, lambda x: x.cast("double"))
        total = F.sum(F.when(F.size(v) > 0, F.aggregate(double, F.lit(0.0), lambda a, x: a + x)))
        n = F.coalesce(F.sum(F.greatest(F.size(v), F.lit(0)).cast("long")), F.lit(0))
        mean = F.try_divide(total, n)
        part = {"count": n, "value_count": n, "min": F.min(F.array_min(v)), "max": F.max(F.array_max(v)), "sum": total, "avg": mean}
        if isinstance(self.of, _Simple):
            return [part[self.of.fn].alias(name)]
        return [part[p].alias(f"{name}_{p}") for p in ("count", "min", "max", "avg", "sum")]

    def output(self, name):
        return self.of.output(name)

    def only_where(self, cond):
        return replace(self, values=F.when(cond, self.values))


@dataclass
class _Exploded(Metric):
    """Any other metric of an array field: over a row for each element."""
    of: Metric
    values: Column
    special = True

    def compute(self, df: DataFrame, keys: list[str], name: str) -> DataFrame:
        rows = df.select(*[F.col(f"`{k}`") for k in keys], F.explode(self.values).alias("_element"))
        return aggregate(rows, keys, {name: replace(self.of, field="_element")}, doc_count=None)

    def output(self, name):
        return self.of.output(name)


def bind(df: DataFrame, metric: Metric) -> Metric:
    """``metric`` for this frame: on a field with several values (an array, or
    a path into an array of objects) each element is a value, and documents
    are still counted once."""
    values = on(df)._values(getattr(metric, "field", None))
    if values is None or isinstance(metric, (_ArrayStats, _Exploded)):
        return metric
    return (_ArrayStats if isinstance(metric, (_Simple, stats)) else _Exploded)(metric, values)


# --- metrics that need a second aggregate over the same keys ---------------

@dataclass
class top_hits(Metric):  # noqa: N801
    """The best ``n`` rows as an array of objects, best first, in any bucket
    and at any level of a tree. ``order``: (field, ``asc`` or ``desc``) keys,
    missing values last; rows that tie on all of them are taken by a hash of
    the row. ``fields``: what is kept of a row (default: all). Rows of a hot
    bucket are ranked by many tasks, each keeps ``n`` (:func:`top_n_per_group`),
    so an array is made of ``n`` rows, never of a bucket's."""
    n: int
    order: Sequence
    fields: Sequence[str] | None = None
    special = True

    def compute(self, df: DataFrame, keys: list[str], name: str) -> DataFrame:
        shown = [f.name for f in df.schema.fields if f.name not in keys and not f.name.startswith("_bucket_key")]
        kept = [F.col(f"`{c}`") for c in (self.fields or shown)]
        by = [as_col(f).alias(f"_by{i}") for i, (f, _) in enumerate(self.order)]
        row = F.struct(*kept).alias("_row")
        rows = df.select(*[F.col(f"`{k}`") for k in keys], *by, row, F.xxhash64(F.to_json(F.struct(row))).alias("_tie"))
        order = [F.col(f"_by{i}").desc_nulls_last() if o == "desc" else F.col(f"_by{i}").asc_nulls_last()
                 for i, (_, o) in enumerate(self.order)]
        best = top_n_per_group(rows, keys, [*order, F.col("_tie")], self.n, rank="_rank")
        # n rows at most; compared by rank alone, as a row may hold maps
        listed = F.array_sort(F.collect_list(F.struct("_rank", "_row")), lambda a, b: a["_rank"] - b["_rank"])
        return best.groupBy(*keys).agg(F.transform(listed, lambda x: x["_row"]).alias(name))


@dataclass
class median_absolute_deviation(Metric):  # noqa: N801
    """median(|x - median(x)|) per group (exact; ``approx=True`` for sketches).
    Medians per group (one row per bucket) are joined back to the rows on the
    group key, then the median of the absolute deviations is taken. The exact
    medians are range-split like :class:`percentiles`, so a hot group is never
    ranked by one task."""
    field: object
    approx: bool = False
    special = True

    def compute(self, df: DataFrame, keys: list[str], name: str) -> DataFrame:
        c = as_col(self.field)
        base = df.select(*keys, c.cast("double").alias("_x")).filter(F.col("_x").isNotNull())
        if self.approx:
            med = lambda x: F.percentile_approx(x, 0.5, 10000)
            centers = base.groupBy(*keys).agg(med(F.col("_x")).alias("_m"))
            dev = _join_on_keys(base, centers, keys, how="inner")
            return dev.groupBy(*keys).agg(med(F.abs(F.col("_x") - F.col("_m"))).alias(name))
        # both medians work on the distinct values of each group with their
        # counts: the raw rows are read once, and the centers are joined to
        # the (smaller) value-count table
        counted = value_counts(base, keys, "_x")
        centers = exact_quantiles(counted, keys, "_x", [0.5], names=["_m"], weight="_c", distinct=True)
        dev = _join_on_keys(counted, centers, keys, how="inner").select(
            *keys, F.abs(F.col("_x") - F.col("_m")).alias("_d"), "_c")
        return exact_quantiles(dev, keys, "_d", [0.5], names=[name], weight="_c")


@dataclass
class string_stats(Metric):  # noqa: N801
    """count, min/max/avg length and Shannon entropy (bits) of the character
    distribution over all values of the group. The entropy is computed from
    per-(group, character) counts: H = log2(T) - sum(c*log2 c)/T."""
    field: object
    special = True

    def compute(self, df: DataFrame, keys: list[str], name: str) -> DataFrame:
        c = as_col(self.field)
        base = df.select(*keys, c.alias("_s")).filter(F.col("_s").isNotNull())
        chars = (base.select(*keys, F.explode(F.split(F.col("_s"), "")).alias("_ch"))
                     .filter(F.col("_ch") != "")
                     .groupBy(*keys, "_ch").agg(F.count("*").alias("_n")))
        return chars.groupBy(*keys).agg(
            (F.log2(F.sum("_n")) - F.sum(F.col("_n") * F.log2("_n")) / F.sum("_n")).alias(f"{name}_entropy"))

    def main_exprs(self, name):
        c = as_col(self.field)
        return [F.count(c).alias(f"{name}_count"), F.min(F.length(c)).alias(f"{name}_min_length"),
                F.max(F.length(c)).alias(f"{name}_max_length"), F.avg(F.length(c)).alias(f"{name}_avg_length")]

    def output(self, name):
        return [f"{name}_{p}" for p in ("count", "min_length", "max_length", "avg_length", "entropy")]


def _join_on_keys(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join per-bucket results on the bucket keys (NULL keys match each
    other). Without keys ``b`` is a global aggregate (exactly one row), so it
    is broadcast: every task of ``a`` joins locally instead of sending all
    rows to one constant key."""
    if keys:
        return join_on_keys(a, b, keys, how=how)
    return a.withColumn("_g", F.lit(0)).join(F.broadcast(b.withColumn("_g", F.lit(0))), on="_g", how=how).drop("_g")


def aggregate(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, Metric] | None = None,
              doc_count: str | None = "doc_count") -> DataFrame:
    """Group ``df`` by the (already computed) key columns and evaluate all
    metrics in one aggregate; special metrics are joined on the keys."""
    keys = list(keys)
    metrics = {n: bind(df, m) for n, m in (metrics or {}).items()}
    simple = {n: m for n, m in metrics.items() if not m.special}
    special = {n: m for n, m in metrics.items() if m.special}
    exprs = []
    if doc_count:
        exprs.append(F.count(F.lit(1)).alias(doc_count))
    for n, m in simple.items():
        exprs += m.exprs(n)
    for n, m in special.items():
        exprs += m.main_exprs(n)
    if not exprs:
        exprs.append(F.count(F.lit(1)).alias("_n"))
    out = df.groupBy(*keys).agg(*exprs)
    posts = []
    for n, m in simple.items():
        p = m.post(n)
        if p is not None:
            posts.append((n, p))
    if posts:
        drop = [f"_{n}_arr" for n, _ in posts]
        out = out.select(*[c for c in out.columns if c not in drop], *[c for _, p in posts for c in p])
    if "_n" in out.columns and not doc_count:
        out = out.drop("_n")
    for n, m in special.items():
        out = _join_on_keys(out, m.compute(df, keys, n), keys, how="left")
    return out

