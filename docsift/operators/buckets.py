"""Bucket aggregations. Each spec's ``run(df)`` returns the bucket table:
key column(s), ``doc_count``, then one column per metric.

All buckets are ``groupBy`` aggregates with map-side partial aggregation, so a
hot key (a third of all rows) is pre-combined in every task and the shuffle
carries one row per (task, bucket). Overlapping buckets (ranges, filters,
adjacency) label each row with an *array* of bucket names and explode it; the
array is bounded by the number of buckets in the spec, never by the data.
Ordering and ``size`` apply to the reduced bucket table only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import as_col, null_safe
from ..functions.predicates import on
from ..functions.text import distinct_tokens
from ..session import cut_lineage
from .metrics import Metric, aggregate, bind, sum_, value_count
from .ordered import join_on_keys, top_n_per_group


def _order_cols(order, key_cols: Sequence[str]) -> list[Column]:
    """``order`` = list of (column, 'asc'|'desc'); ``_count``/``_key`` aliases.
    The key columns are always appended ascending as a unique tie-breaker."""
    out = []
    for c, d in order:
        name = {"_count": "doc_count", "_key": None}.get(c, c)
        cols = list(key_cols) if name is None else [name]
        for n in cols:
            out.append(F.col(n).desc_nulls_last() if d == "desc" else F.col(n).asc_nulls_last())
    out += [F.col(k).asc_nulls_last() for k in key_cols]
    return out


def _finish(out: DataFrame, order, keys: Sequence[str], size: int | None,
            min_doc_count: int = 1) -> DataFrame:
    if min_doc_count > 1:
        out = out.filter(F.col("doc_count") >= min_doc_count)
    ordered = out.orderBy(*_order_cols(order, keys))
    return ordered.limit(size) if size is not None else ordered


class BucketAgg:
    def run(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def keyed(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the bucket's key as column ``name``: a row for each
        bucket a document is in, none for documents in no bucket."""
        raise NotImplementedError(f"{type(self).__name__} has no keys to nest")

    def one_key(self, df: DataFrame) -> Column | None:
        """The key as an expression where a document lies in one bucket at
        most (NULL: in none), else None. Such aggregations share a scan
        (:func:`run_together`), as ``finish`` makes the result of their
        ``_bucket_key, doc_count, metrics`` table."""
        return None

    def finish(self, out: DataFrame) -> DataFrame:
        raise NotImplementedError

    def shown_key(self, c: Column) -> Column:
        """The bucket's key from :meth:`one_key`'s value."""
        return c


#: Key column while metrics are computed: a document field may be called "key".
_KEY = "_bucket_key"


def _values(df: DataFrame, field_) -> Column | None:
    """The distinct values of an array field (a document is in one bucket for
    each), or None for a plain field."""
    if isinstance(field_, Column):
        return None
    values = on(df)._values(field_)
    return None if values is None else F.array_distinct(values)


def bound_cond(df: DataFrame, cond) -> Column:
    """A condition for this frame: a Column, or a function of the frame's
    predicates (:func:`docsift.functions.predicates.on`), which know fields
    with several values."""
    return cond if isinstance(cond, Column) else cond(on(df))


def _keyed_values(df: DataFrame, name: str, values: Column, key) -> DataFrame:
    """A row for each distinct key of a document's values; none without."""
    keys = F.array_distinct(F.filter(F.transform(values, key), lambda k: k.isNotNull()))
    return df.withColumn(name, F.explode(keys))


@dataclass
class terms(BucketAgg):  # noqa: N801
    """One bucket per distinct value. Default order: doc_count desc, key asc.
    An array field has a bucket for each element, with the documents that hold
    it. ``missing`` puts NULLs into a bucket with that key (else they are skipped);
    ``include``/``exclude`` are whole-value regular expressions;
    ``case_insensitive`` buckets on the lower-cased value."""
    field: object
    size: int | None = None
    metrics: Mapping[str, Metric] = field(default_factory=dict)
    order: Sequence = (("_count", "desc"),)
    min_doc_count: int = 1
    include: str | None = None
    exclude: str | None = None
    missing: object = None
    case_insensitive: bool = False
    key_name: str = "key"

    def key_col(self, c: Column) -> Column:
        if self.case_insensitive:
            c = F.lower(c)
        if self.missing is not None:
            c = F.coalesce(c, F.lit(self.missing))
        return c

    def keyed(self, df: DataFrame, name: str) -> DataFrame:
        values = _values(df, self.field)
        if values is None:
            out = df.withColumn(name, self.key_col(as_col(self.field)))
        else:
            # one bucket for each element, a document once in each
            values = F.array_distinct(F.transform(values, self.key_col))
            if self.missing is not None:
                values = F.when(F.size(values) > 0, values).otherwise(F.array(F.lit(self.missing)))
            out = df.withColumn(name, F.explode(values))
        out = out.filter(F.col(name).isNotNull())
        if self.include is not None:
            out = out.filter(F.col(name).cast("string").rlike(rf"\A(?:{self.include})\z"))
        if self.exclude is not None:
            out = out.filter(~F.col(name).cast("string").rlike(rf"\A(?:{self.exclude})\z"))
        return out

    def run(self, df: DataFrame) -> DataFrame:
        return self.finish(aggregate(self.keyed(df, _KEY), [_KEY], self.metrics))

    def one_key(self, df: DataFrame) -> Column | None:
        if type(self) is not terms or _values(df, self.field) is not None:
            return None
        key = self.key_col(as_col(self.field))
        text = key.cast("string")
        if self.include is not None:
            key = F.when(text.rlike(rf"\A(?:{self.include})\z"), key)
        if self.exclude is not None:
            key = F.when(~text.rlike(rf"\A(?:{self.exclude})\z"), key)
        return key

    def finish(self, out: DataFrame) -> DataFrame:
        out = out.withColumnRenamed(_KEY, self.key_name)
        return _finish(out, self.order, [self.key_name], self.size, self.min_doc_count)


@dataclass
class token_buckets(terms):  # noqa: N801
    """Terms buckets over the word tokens of a text field: a document counts
    once for each of its tokens."""

    def keyed(self, df: DataFrame, name: str) -> DataFrame:
        name_ = f"{name}_tokens"
        held = df.withColumn(name_, distinct_tokens(self.field))
        return replace(terms(name_), include=self.include, exclude=self.exclude).keyed(held, name).drop(name_)


@dataclass
class composite(BucketAgg):  # noqa: N801
    """Buckets over several keys, ordered by the key tuple; ``after`` resumes
    after a given key tuple (paging through all buckets)."""
    sources: Sequence  # (name, field or Column)
    size: int | None = None
    after: Sequence | None = None
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def run(self, df: DataFrame) -> DataFrame:
        names = [n for n, _ in self.sources]
        hidden = [f"{_KEY}_{i}" for i in range(len(names))]
        src = df
        for _, c in self.sources:
            src = src.filter(as_col(c).isNotNull())
        if self.after is not None:
            # spelled out, so that the first key's bound reaches the scan
            keys, bounds = [as_col(c) for _, c in self.sources], [F.lit(v) for v in self.after]
            later = keys[-1] > bounds[-1]
            for k, v in zip(keys[-2::-1], bounds[-2::-1]):
                later = (k > v) | ((k == v) & later)
            src = src.filter((keys[0] >= bounds[0]) & later)
        keyed = src.withColumns(dict(zip(hidden, [as_col(c) for _, c in self.sources])))
        out = aggregate(keyed, hidden, self.metrics).withColumnsRenamed(dict(zip(hidden, names)))
        ordered = out.orderBy(*[F.col(n).asc() for n in names])
        return ordered.limit(self.size) if self.size is not None else ordered


@dataclass
class histogram(BucketAgg):  # noqa: N801
    """Fixed-width numeric buckets: key = floor((x - offset)/interval)*interval + offset.
    ``min_doc_count=0`` also returns the empty buckets between the first and
    the last non-empty one (generated from a one-row bounds aggregate). NaN
    and infinite values are in no bucket."""
    field: object
    interval: float
    offset: float = 0.0
    min_doc_count: int = 1
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def _index(self, x: Column) -> Column:
        x = x.cast("double")
        finite = ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
        return F.floor((F.when(finite, x) - F.lit(self.offset)) / F.lit(self.interval))

    def one_key(self, df: DataFrame) -> Column | None:
        return None if _values(df, self.field) is not None else self._index(as_col(self.field))

    def shown_key(self, c: Column) -> Column:
        return c.cast("double") * F.lit(float(self.interval)) + F.lit(float(self.offset))

    def _numbered(self, df: DataFrame, name: str) -> DataFrame:
        values = _values(df, self.field)
        if values is not None:
            return _keyed_values(df, name, values, self._index)
        return df.withColumn(name, self._index(as_col(self.field))).filter(F.col(name).isNotNull())

    def keyed(self, df: DataFrame, name: str) -> DataFrame:
        start = F.col(name).cast("double") * F.lit(float(self.interval)) + F.lit(float(self.offset))
        return self._numbered(df, name).withColumn(name, start)

    def run(self, df: DataFrame) -> DataFrame:
        return self.finish(aggregate(self._numbered(df, _KEY), [_KEY], self.metrics))

    def finish(self, out: DataFrame) -> DataFrame:
        out = out.withColumnRenamed(_KEY, "_idx")
        if self.min_doc_count == 0:
            out = _fill_gaps(out)
        elif self.min_doc_count > 1:
            out = out.filter(F.col("doc_count") >= self.min_doc_count)
        key = (F.col("_idx").cast("double") * F.lit(float(self.interval)) + F.lit(float(self.offset))).alias("key")
        return out.select(key, *[c for c in out.columns if c != "_idx"]).orderBy("key")


def _fill_gaps(out: DataFrame, idx: str = "_idx") -> DataFrame:
    """Add the empty buckets between the first and the last one.

    Buckets are numbered by a bigint index; the index range comes from a
    one-row aggregate and the full range is generated by ``spark.range``,
    which is split across tasks, so a fine interval over a long span never
    materialises in one row or one task. The bucket table (checkpointed, as
    the bounds and the result read it) is left-joined on it."""
    out = cut_lineage(out)
    b = out.agg(F.min(idx).alias("lo"), F.max(idx).alias("hi")).first()
    if b is None or b["lo"] is None:
        return out
    every = out.sparkSession.range(int(b["lo"]), int(b["hi"]) + 1).withColumnRenamed("id", idx)
    filled = every.join(out, on=idx, how="left")
    return filled.withColumn("doc_count", F.coalesce(F.col("doc_count"), F.lit(0)))


_CALENDAR = ("minute", "hour", "day", "week", "month", "quarter", "year")
_FIXED_UNITS_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
                   "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}
# Fixed value: weeks start on Monday; 1969-12-29 is the Monday before the epoch.
_MONDAY_EPOCH_US = -3 * 86_400_000_000


def interval_micros(text: str) -> int:
    """'6 hours' / '90 seconds' / '1 day' -> microseconds."""
    n, unit = text.split()
    unit = unit.lower().rstrip("s")
    if unit not in _FIXED_UNITS_US:
        raise ValueError(f"fixed intervals use {sorted(_FIXED_UNITS_US)}, got {text!r}")
    return int(n) * _FIXED_UNITS_US[unit]


def _micros(ts: Column) -> Column:
    # timestamp_ntz -> microseconds since the epoch of its wall-clock value
    # (sessions built by build_session use UTC)
    return F.unix_micros(ts.cast("timestamp"))


def _floor_div(x: Column, step: int) -> Column:
    return F.call_function("div", x - F.pmod(x, F.lit(step)), F.lit(step))


@dataclass
class date_histogram(BucketAgg):  # noqa: N801
    """Time buckets. ``calendar_interval`` in minute/hour/day/week/month/
    quarter/year (calendar-aware; weeks start on Monday) or ``fixed_interval``
    such as ``'6 hours'`` (epoch-aligned). ``min_doc_count=0`` fills empty
    buckets between the first and last one."""
    field: object
    calendar_interval: str | None = None
    fixed_interval: str | None = None
    min_doc_count: int = 1
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def _step_us(self) -> int | None:
        if self.fixed_interval:
            return interval_micros(self.fixed_interval)
        if self.calendar_interval in ("minute", "hour", "day", "week"):
            return _FIXED_UNITS_US[self.calendar_interval]
        return None

    def _origin_us(self) -> int:
        return _MONDAY_EPOCH_US if self.calendar_interval == "week" else 0

    def to_index(self, ts: Column) -> Column:
        """Bucket number of a timestamp (consecutive buckets differ by 1)."""
        step = self._step_us()
        if step is not None:
            # whole-number division, rounded down also before the origin
            us = _micros(ts) - F.lit(self._origin_us())
            return _floor_div(us, step)
        y, m = F.year(ts).cast("bigint"), F.month(ts).cast("bigint")
        if self.calendar_interval == "month":
            return y * 12 + m - 1
        if self.calendar_interval == "quarter":
            return y * 4 + F.floor((m - 1) / 3).cast("bigint")
        if self.calendar_interval == "year":
            return y
        raise ValueError(f"calendar_interval must be one of {_CALENDAR}")

    def from_index(self, idx: Column) -> Column:
        """Start timestamp (timestamp_ntz) of bucket number ``idx``."""
        step = self._step_us()
        if step is not None:
            return F.timestamp_micros(idx * F.lit(step) + F.lit(self._origin_us())).cast("timestamp_ntz")
        if self.calendar_interval == "month":
            y, m = F.floor(idx / 12), F.pmod(idx, F.lit(12)) + 1
        elif self.calendar_interval == "quarter":
            y, m = F.floor(idx / 4), F.pmod(idx, F.lit(4)) * 3 + 1
        else:
            y, m = idx, F.lit(1)
        return F.make_timestamp_ntz(y.cast("int"), m.cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))

    def key_col(self) -> Column:
        if not (self.calendar_interval or self.fixed_interval):
            raise ValueError("give calendar_interval or fixed_interval")
        return self.from_index(self.to_index(as_col(self.field)))

    def keyed(self, df: DataFrame, name: str) -> DataFrame:
        if _values(df, self.field) is None:
            return df.withColumn(name, self.key_col()).filter(F.col(name).isNotNull())
        return self._numbered(df, name).withColumn(name, self.from_index(F.col(name)))

    def one_key(self, df: DataFrame) -> Column | None:
        return None if _values(df, self.field) is not None else self.to_index(as_col(self.field))

    def shown_key(self, c: Column) -> Column:
        return self.from_index(c)

    def _numbered(self, df: DataFrame, name: str) -> DataFrame:
        values = _values(df, self.field)
        if values is not None:
            return _keyed_values(df, name, values, self.to_index)
        return df.withColumn(name, self.to_index(as_col(self.field))).filter(F.col(name).isNotNull())

    def run(self, df: DataFrame) -> DataFrame:
        return self.finish(aggregate(self._numbered(df, _KEY), [_KEY], self.metrics))

    def finish(self, out: DataFrame) -> DataFrame:
        out = out.withColumnRenamed(_KEY, "_idx")
        if self.min_doc_count == 0:
            out = _fill_gaps(out)
        elif self.min_doc_count > 1:
            out = out.filter(F.col("doc_count") >= self.min_doc_count)
        return (out.select(self.from_index(F.col("_idx")).alias("key"), *[c for c in out.columns if c != "_idx"])
                   .orderBy("key"))


def _labelled(df: DataFrame, labelled: Sequence[tuple[str, Column]], metrics: Mapping[str, Metric]) -> DataFrame:
    """Buckets given by conditions: ``key``, ``_pos``, ``doc_count`` and the
    metrics, a row for each, also for empty ones.

    One aggregate without keys holds every bucket's numbers (a metric over the
    rows of a bucket hides its field elsewhere), and its single row is then
    turned into one row for each bucket: rows are neither multiplied nor
    shuffled. Metrics that need a pass of their own (exact percentiles and the
    like) are computed over labelled copies of the rows."""
    parts, plain = [], True
    for pos, (label, cond) in enumerate(labelled):
        hit = null_safe(cond)
        own = {n: bind(df, m).only_where(hit) for n, m in metrics.items()}
        plain = plain and all(m is not None and m.post(n) is None for n, m in own.items())
        parts.append((pos, label, hit, own))
    spark = df.sparkSession
    if not plain:
        out = aggregate(_label_explode(df, labelled, _KEY), [_KEY], metrics).withColumnRenamed(_KEY, "key")
        spec = _spec_table(spark, [(k, i) for i, (k, _) in enumerate(labelled)], "key string, _pos int")
        return spec.join(out, on="key", how="left").withColumn("doc_count", F.coalesce("doc_count", F.lit(0)))
    exprs, rows = [], []
    for pos, label, hit, own in parts:
        exprs.append(F.count(F.when(hit, 1)).alias(f"_{pos}_n"))
        fields = [F.lit(label).alias("key"), F.lit(pos).alias("_pos"), F.col(f"_{pos}_n").alias("doc_count")]
        for n, m in own.items():
            exprs += m.exprs(f"_{pos}_{n}")
            fields += [F.col(f"`{c}`").alias(o) for c, o in zip(m.output(f"_{pos}_{n}"), m.output(n))]
        rows.append(F.struct(*fields))
    return df.agg(*exprs).select(F.inline(F.array(*rows)))


class Results(Mapping):
    """Results of several named aggregations, each planned when it is asked
    for. The first is a plan of its own, so reading one costs one scan of its
    own fields. With the second, all those not yet read are computed together
    in one scan (:func:`run_together`)."""

    def __init__(self, df: DataFrame, specs: Mapping[str, BucketAgg], ready: Mapping[str, DataFrame]):
        self._df, self._specs, self._ready = df, dict(specs), dict(ready)
        self._names = [*self._ready, *self._specs]
        self._asked = False

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._ready:
            if self._asked:
                left = {n: s for n, s in self._specs.items() if n not in self._ready}
                self._ready |= run_together(self._df, left)
            else:
                self._ready[name] = self._specs[name].run(self._df)
                self._asked = True
        return self._ready[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def run_together(df: DataFrame, specs: Mapping[str, BucketAgg]) -> dict[str, DataFrame]:
    """Several bucket aggregations in one scan, by grouping sets: each row is
    counted for every aggregation inside its task (partial aggregation) before
    anything is shuffled. The reduced table is checkpointed, as every result
    reads it. Aggregations that do not fit (rows in several buckets, metrics
    with a pass of their own) run by themselves."""
    fit = {}
    for name, spec in specs.items():
        key = spec.one_key(df)
        if key is not None and not any(m.special or m.post(n) for n, m in spec.metrics.items()):
            fit[name] = key
    if len(fit) < 2:
        return {name: spec.run(df) for name, spec in specs.items()}
    keys = {name: f"{_KEY}_{i}" for i, name in enumerate(fit)}
    wide = df.withColumns({keys[n]: c for n, c in fit.items()})
    exprs = [F.count(F.lit(1)).alias("doc_count"), F.grouping_id(*keys.values()).alias("_set")]
    for i, name in enumerate(fit):
        for n, m in specs[name].metrics.items():
            exprs += m.exprs(f"_{i}_{n}")
    table = cut_lineage(wide.groupingSets([[k] for k in keys.values()], *keys.values()).agg(*exprs))
    out = {}
    for i, (name, key) in enumerate(keys.items()):
        mine = (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i))  # bits of the keys that are rolled up
        cols = [F.col(key).alias(_KEY), F.col("doc_count")]
        for n, m in specs[name].metrics.items():
            cols += [F.col(f"`{a}`").alias(b) for a, b in zip(m.output(f"_{i}_{n}"), m.output(n))]
        out[name] = specs[name].finish(table.filter((F.col("_set") == mine) & F.col(key).isNotNull()).select(*cols))
    return {name: out[name] if name in out else spec.run(df) for name, spec in specs.items()}


def _label_explode(df: DataFrame, labelled: Sequence[tuple[str, Column]], name: str = "key") -> DataFrame:
    """Explode each row into the names of the (possibly overlapping) buckets it
    belongs to. Rows in no bucket disappear."""
    arr = F.filter(F.array(*[F.when(null_safe(cond), F.lit(lbl)) for lbl, cond in labelled]),
                   lambda x: x.isNotNull())
    return df.withColumn(name, F.explode(arr))


def _spec_table(spark, rows, schema) -> DataFrame:
    # built from the request itself: one row per requested bucket
    return spark.createDataFrame(rows, schema)


@dataclass
class range_(BucketAgg):  # noqa: N801
    """Half-open ranges [from, to), possibly overlapping; every requested range
    is returned, empty ones with doc_count 0. ``ranges`` = (key, from, to)
    with ``None`` for an open end. Works for numbers and timestamps."""
    field: object
    ranges: Sequence
    metrics: Mapping[str, Metric] = field(default_factory=dict)
    bound_type: str = "double"

    def keyed(self, df: DataFrame, name: str) -> DataFrame:
        return _label_explode(df, self._conditions(df), name)

    def _conditions(self, df: DataFrame) -> list[tuple[str, Column]]:
        values = _values(df, self.field)

        def inside(x: Column, lo, hi) -> Column:
            cond = x.isNotNull()
            if lo is not None:
                cond = cond & (x >= F.lit(lo))
            if hi is not None:
                cond = cond & (x < F.lit(hi))
            return cond

        if values is None:
            return [(key, inside(as_col(self.field), lo, hi)) for key, lo, hi in self.ranges]
        any_ = lambda lo, hi: F.exists(values, lambda x: null_safe(inside(x, lo, hi)))
        return [(key, any_(lo, hi)) for key, lo, hi in self.ranges]

    def run(self, df: DataFrame) -> DataFrame:
        out = _labelled(df, self._conditions(df), self.metrics)
        bound = lambda side: F.element_at(F.array(*[
            F.lit(r[side]).cast(self.bound_type) for r in self.ranges]), F.col("_pos") + 1)
        rest = [c for c in out.columns if c not in ("key", "_pos")]
        return out.orderBy("_pos").select("key", bound(1).alias("from"), bound(2).alias("to"), *rest)


def date_range(field, ranges, metrics=None) -> range_:
    return range_(field, ranges, metrics or {}, bound_type="timestamp_ntz")


@dataclass
class filters(BucketAgg):  # noqa: N801
    """Named filter buckets (may overlap); ``other_bucket_key`` collects the
    rows matching none. Every named bucket is returned, empty ones with 0. A
    condition may be a function of the frame's predicates."""
    named: Mapping[str, object]
    other_bucket_key: str | None = None
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def keyed(self, df: DataFrame, name: str) -> DataFrame:
        return _label_explode(df, self._conditions(df), name)

    def _conditions(self, df: DataFrame) -> list[tuple[str, Column]]:
        labelled = [(n, bound_cond(df, c)) for n, c in self.named.items()]
        if self.other_bucket_key:
            none = F.lit(True)
            for _, c in labelled:
                none = none & ~null_safe(c)
            labelled.append((self.other_bucket_key, none))
        return labelled

    def run(self, df: DataFrame) -> DataFrame:
        return _labelled(df, self._conditions(df), self.metrics).orderBy("_pos").drop("_pos")


def filter_(cond, metrics=None) -> "single_bucket":
    return single_bucket(cond, metrics or {})


@dataclass
class single_bucket(BucketAgg):  # noqa: N801
    """One bucket: the rows matching ``cond`` (``filter``), or with the field
    missing (``missing``). One row: doc_count + metrics. ``cond`` may be a
    function of the frame's predicates."""
    cond: object
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def run(self, df: DataFrame) -> DataFrame:
        return aggregate(df.filter(bound_cond(df, self.cond)), [], self.metrics)


def missing(field_, metrics=None) -> single_bucket:
    """Documents without a value in the field; an array without a value in any
    element has none."""
    cond = (lambda p: p.missing(field_)) if isinstance(field_, str) else field_.isNull()
    return single_bucket(cond, metrics or {})


@dataclass
class global_(BucketAgg):  # noqa: N801
    """Aggregate over all documents of the resource, ignoring the query
    (the search executor hands it the unfiltered frame)."""
    metrics: Mapping[str, Metric] = field(default_factory=dict)
    ignores_query = True

    def run(self, df: DataFrame) -> DataFrame:
        return aggregate(df, [], self.metrics)


@dataclass
class sub_terms(BucketAgg):  # noqa: N801
    """Nested terms buckets to any depth, in long form: one row per bucket
    path with each level's key and doc_count; ``size`` limits buckets per
    parent (ranked by doc_count desc, key asc). ``levels`` = (name, field, size).

    One aggregate at the deepest level; the parent counts are roll-ups of that
    reduced table, and the per-parent ranking is a window partitioned by the
    parent path over the bucket table (never over raw rows)."""
    levels: Sequence
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def run(self, df: DataFrame) -> DataFrame:
        names = [n for n, _, _ in self.levels]
        keyed = df.withColumns({n: as_col(f) for n, f, _ in self.levels})
        for n in names:
            keyed = keyed.filter(F.col(n).isNotNull())
        leaf = aggregate(keyed, names, self.metrics).withColumnRenamed("doc_count", f"{names[-1]}_doc_count")
        leaf = cut_lineage(leaf)  # read once for each level
        out = leaf
        for i, (n, _, size) in enumerate(self.levels):
            path = names[: i + 1]
            if i < len(self.levels) - 1:
                counts = leaf.groupBy(*path).agg(F.sum(f"{names[-1]}_doc_count").alias(f"{n}_doc_count"))
            else:
                counts = leaf.select(*path, f"{n}_doc_count")
            if size is not None and i == 0:
                counts = counts.orderBy(F.col(f"{n}_doc_count").desc(), F.col(n).asc()).limit(size)
            elif size is not None:
                counts = top_n_per_group(counts, names[:i], [F.col(f"{n}_doc_count").desc(), F.col(n).asc()],
                                         size)
            if i < len(self.levels) - 1:
                out = out.join(counts, on=path, how="inner")
            else:
                out = out.join(counts.select(*path), on=path, how="left_semi")
        cols = []
        for n in names:
            cols += [n, f"{n}_doc_count"]
        rest = [c for c in out.columns if c not in cols]
        return out.select(*cols, *rest).orderBy(*[F.col(n) for n in names])


#: Child and parent rows that a task joins and aggregates, about (some 100 MB).
ROWS_BY_PARENT = 1 << 18


def by_parent(child: DataFrame, parents: DataFrame, parent_key: str) -> tuple[DataFrame, DataFrame]:
    """``child``, of it the rows that have a parent, and ``parents``, both dealt
    by parent to as many tasks as their rows ask for (counted first), which AQE
    leaves as they are. :class:`nested_terms` then works in these tasks without
    another shuffle of the rows, and what a task holds does not grow with the
    tables."""
    n = max(1, -(-(child.count() + parents.count()) // ROWS_BY_PARENT))
    child, parents = (df.repartition(n, parent_key) for df in (child, parents))
    # not a semi join: Spark moves that one below the repartition, where AQE merges its tasks
    return child.join(parents.select(parent_key).distinct(), parent_key), parents


@dataclass
class nested_terms(BucketAgg):
    """Buckets over the elements of a nested collection stored as its own
    (child) table: doc_count counts elements, ``parent_count`` counts distinct
    parents (``reverse_nested``). ``run`` takes the child table, already
    restricted to the parents of interest by the caller (:func:`by_parent`, or
    e.g. a semi join).

    ``parent_metrics`` are metrics of the parents of a bucket's elements, each
    parent counted once per bucket, however many of its elements are in it.
    Their fields come from the table ``parents`` by ``parent_key``, or stand in
    the child rows (the same in all rows of a parent). Two steps: one row for
    each (bucket, parent), then the aggregate; a hot bucket is many parents,
    so it is spread in the first and pre-combined in the second."""
    field: object
    parent_key: str
    size: int | None = None
    metrics: Mapping[str, Metric] = field(default_factory=dict)
    parent_metrics: Mapping[str, Metric] = field(default_factory=dict)
    parents: DataFrame | None = None

    def _of_parents(self, keyed: DataFrame) -> DataFrame:
        """Bucket, element count, parent count and the parents' metrics."""
        fields = [] if self.parents is not None else [c for c in keyed.columns if c not in (_KEY, self.parent_key)]
        used = [c for c in fields if c in {getattr(m, "field", None) for m in self.parent_metrics.values()}
                | {getattr(m, a, None) for m in self.parent_metrics.values() for a in ("value", "weight")}]
        once = keyed.groupBy(_KEY, self.parent_key).agg(F.count(F.lit(1)).alias("_elements"), *[F.first(c).alias(c) for c in used])
        if self.parents is not None:
            once = once.join(self.parents.dropDuplicates([self.parent_key]), self.parent_key, "left")
        own = {"_elements": sum_("_elements"), "parent_count": value_count(self.parent_key), **self.parent_metrics}
        return aggregate(once, [_KEY], own, doc_count=None).withColumnRenamed("_elements", "doc_count")

    def run(self, child: DataFrame) -> DataFrame:
        keyed = child.withColumn(_KEY, as_col(self.field)).filter(F.col(_KEY).isNotNull())
        m = dict(self.metrics)
        if self.parent_metrics:
            out = self._of_parents(keyed)
            if m:
                out = join_on_keys(out, aggregate(keyed, [_KEY], m, doc_count=None), [_KEY])
            return _finish(out.withColumnRenamed(_KEY, "key"), (("_count", "desc"),), ["key"], self.size)
        from .metrics import cardinality
        m["parent_count"] = cardinality(self.parent_key)
        out = aggregate(keyed, [_KEY], m).withColumnRenamed(_KEY, "key")
        return _finish(out, (("_count", "desc"),), ["key"], self.size)


def nested_array_terms(df: DataFrame, array_field: str, element_field: str, parent_key: str,
                       size: int | None = None, metrics: Mapping[str, Metric] | None = None,
                       parent_metrics: Mapping[str, Metric] | None = None) -> DataFrame:
    """Same as :class:`nested_terms` when the elements are an array-of-struct
    column of the parent: explode, then bucket. Parents' fields are those of
    ``df``."""
    child = df.select(parent_key, F.explode(array_field).alias("_e")).select(parent_key, "_e.*")
    parents = df.drop(array_field) if parent_metrics else None
    return nested_terms(element_field, parent_key, size, metrics or {}, parent_metrics or {}, parents).run(child)


@dataclass
class adjacency_matrix(BucketAgg):  # noqa: N801
    """Co-occurrence of named filters: a bucket per filter ``A`` and per pair
    ``A&B`` (names in sorted order) with the number of rows matching both.
    Empty buckets are not returned. A condition may be a function of the
    frame's predicates.

    Without metrics a row becomes one mask of the filters that it matches. Rows
    are counted by mask (inside the tasks first), and only the table of
    distinct masks is turned into pairs: no row is multiplied, and no row
    evaluates a pair. With metrics, each pair is a condition of its own."""
    named: Mapping[str, object]
    separator: str = "&"
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def keyed(self, df: DataFrame, name: str) -> DataFrame:
        return _label_explode(df, self._conditions(df), name)

    def _conditions(self, df: DataFrame) -> list[tuple[str, Column]]:
        own = {n: null_safe(bound_cond(df, c)) for n, c in sorted(self.named.items())}
        labels = list(own.items())
        for i, (a, x) in enumerate(labels[:]):
            labels += [(f"{a}{self.separator}{b}", x & own[b]) for b in list(own)[i + 1:]]
        return labels

    def _by_mask(self, df: DataFrame) -> DataFrame:
        names = sorted(self.named)
        bits = [F.when(null_safe(bound_cond(df, self.named[n])), F.lit(i)) for i, n in enumerate(names)]
        mask = F.array_compact(F.array(*bits)).alias("mask")
        counted = df.select(mask).groupBy("mask").agg(F.count(F.lit(1)).alias("n"))
        label = lambda i: F.element_at(F.array(*[F.lit(n) for n in names]), i + 1)
        pair = lambda i: F.transform(F.filter("mask", lambda j: j > i),
                                     lambda j: F.concat(label(i), F.lit(self.separator), label(j)))
        keys = F.flatten(F.transform("mask", lambda i: F.concat(F.array(label(i)), pair(i))))
        return (counted.select(F.explode(keys).alias("key"), "n").groupBy("key")
                .agg(F.sum("n").alias("doc_count")).orderBy("key"))

    def run(self, df: DataFrame) -> DataFrame:
        if not self.metrics:
            return self._by_mask(df)
        out = _labelled(df, self._conditions(df), self.metrics).filter(F.col("doc_count") > 0)
        return out.drop("_pos").orderBy("key")


@dataclass
class tree(BucketAgg):
    """Any buckets inside any buckets, to any depth. ``levels`` = (name, bucket
    spec[, size]): one row for each path of buckets, with each level's key
    ``<name>``, ``<name>_doc_count`` and its metrics ``<name>_<metric>``.
    ``size`` keeps the largest buckets of each parent (ties by key).

    Where a document lies in one bucket of each level at most, and the metrics
    can be put together (counts, sums, smallest and largest values, means),
    the rows are aggregated once, by the keys of all levels; each parent is
    made of its children in that reduced table, which is checkpointed. Else
    each level is one aggregate over the rows keyed so far, so a document that
    lies in several buckets of a lower level counts once in the upper one."""
    levels: Sequence

    def _rolled_up(self, df: DataFrame) -> DataFrame | None:
        """All levels from one scan, or None."""
        specs = [(level[0], level[1], (*level, None)[2]) for level in self.levels]
        keys, parts = [spec.one_key(df) for _, spec, _ in specs], {}
        for name, spec, _ in specs:
            for n, m in spec.metrics.items():
                parts[name, n] = bind(df, m).partials(f"{name}_{n}")
        if len(specs) < 2 or any(k is None for k in keys) or any(p is None for p in parts.values()):
            return None
        hidden = [f"{_KEY}_{i}" for i in range(len(specs))]
        rows = df.withColumns(dict(zip(hidden, keys))).filter(F.col(hidden[0]).isNotNull())
        every = [p for own in parts.values() for p in own]
        # a row without a bucket of a lower level still counts in the upper ones
        leaf = cut_lineage(rows.groupBy(*hidden).agg(F.count(F.lit(1)).alias("_n"), *[e.alias(c) for c, e, _ in every]))
        out = None
        for i, (name, spec, size) in enumerate(specs):
            path = hidden[: i + 1]
            own = [p for (level, _), p in parts.items() if level == name for p in p]
            got = leaf.filter(F.col(path[-1]).isNotNull()) if i == 0 else leaf.filter(" AND ".join(f"{p} IS NOT NULL" for p in path))
            got = got.groupBy(*path).agg(F.sum("_n").alias(f"{name}_doc_count"), *[add(c).alias(c) for c, _, add in own])
            metrics = [c for n, m in spec.metrics.items() for c in bind(df, m).merged(f"{name}_{n}")]
            got = got.select(*path, f"{name}_doc_count", *metrics)
            least = getattr(spec, "min_doc_count", 1)
            if least > 1:
                got = got.filter(F.col(f"{name}_doc_count") >= least)
            if size is not None:
                got = top_n_per_group(got, path[:-1], [F.col(f"{name}_doc_count").desc(), F.col(path[-1]).asc()], size)
            out = got if out is None else out.join(got, path[:-1])
        shown = [spec.shown_key(F.col(h)).alias(name) for h, (name, spec, _) in zip(hidden, specs)]
        out = out.select(*shown, *[c for c in out.columns if c not in hidden])
        return out.orderBy(*[F.col(name) for name, _, _ in specs])

    def run(self, df: DataFrame) -> DataFrame:
        rolled = self._rolled_up(df)
        if rolled is not None:
            return rolled
        names, out = [], None
        hidden = {level[0]: f"{_KEY}_{i}" for i, level in enumerate(self.levels)}
        for level in self.levels:
            name, spec, size = (*level, None)[:3]
            names.append(hidden[name])
            df = spec.keyed(df, hidden[name])
            got = aggregate(df, names, spec.metrics)
            got = got.withColumnsRenamed({c: f"{name}_{c}" for c in got.columns if c not in names})
            least = getattr(spec, "min_doc_count", 1)
            if least > 1:
                got = got.filter(F.col(f"{name}_doc_count") >= least)
            if size is not None:
                got = top_n_per_group(got, names[:-1], [F.col(f"{name}_doc_count").desc(), F.col(names[-1]).asc()], size)
            out = got if out is None else out.join(got, names[:-1])
        shown = {h: n for n, h in hidden.items()}
        return out.withColumnsRenamed(shown).orderBy(*[F.col(n) for n in hidden])


@dataclass
class spec_of(BucketAgg):  # noqa: N801
    """Any function from rows to a bucket table as a named aggregation, so it
    can stand in a request with a query (token, rare and significant terms)."""
    function: object
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def run(self, df: DataFrame) -> DataFrame:
        return self.function(df)


@dataclass
class rare_terms(BucketAgg):  # noqa: N801
    """Values of a field (one bucket for each element of an array) found in at
    most ``max_doc_count`` documents."""
    field: object
    max_doc_count: int = 1
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def keyed(self, df: DataFrame, name: str) -> DataFrame:
        return terms(self.field).keyed(df, name)

    def run(self, df: DataFrame) -> DataFrame:
        out = aggregate(self.keyed(df, _KEY), [_KEY], self.metrics).withColumnRenamed(_KEY, "key")
        return out.filter(F.col("doc_count") <= self.max_doc_count).orderBy("doc_count", "key")


@dataclass
class significant_terms(BucketAgg):  # noqa: N801
    """Values of a field over-represented among the rows that match
    ``foreground``, against all rows: score = (fg% - bg%) * fg% / bg%."""
    field: object
    foreground: Column
    size: int | None = None
    min_doc_count: int = 1

    def run(self, df: DataFrame) -> DataFrame:
        hit = null_safe(self.foreground)
        total = df.agg(F.count(F.lit(1)).alias("bg"), F.count(F.when(hit, 1)).alias("fg")).first()
        flagged = terms(self.field).keyed(df.withColumn("_fg", hit), _KEY)
        out = flagged.groupBy(F.col(_KEY).alias("key")).agg(
            F.count(F.when(F.col("_fg"), 1)).alias("doc_count"), F.count(F.lit(1)).alias("bg_count"))
        fg = F.col("doc_count") / F.lit(float(total["fg"] or "nan"))
        bg = F.col("bg_count") / F.lit(float(total["bg"] or "nan"))
        out = out.withColumn("score", (fg - bg) * fg / bg).filter(
            (F.col("doc_count") >= self.min_doc_count) & (F.col("score") > 0))
        out = out.orderBy(F.col("score").desc(), F.col("key").asc())
        return out.limit(self.size) if self.size is not None else out


@dataclass
class sampler(BucketAgg):  # noqa: N801
    """Run sub-aggregations on a sample: the ``shard_size`` best rows by a
    score column (top-k, bounded), or a deterministic hash sample keeping rows
    with ``md5(id)`` (its first 8 hex digits) divisible by ``modulus``."""
    inner: BucketAgg
    score: object | None = None
    shard_size: int | None = None      # rows kept by score; needed with a score
    tie_breaker: str | None = None
    hash_field: str | None = None
    modulus: int = 10
    min_score: float | None = None

    def sample(self, df: DataFrame) -> DataFrame:
        if self.score is not None:
            if self.shard_size is None:
                raise ValueError("sampling by score needs shard_size")
            order = [as_col(self.score).desc_nulls_last()]
            if self.tie_breaker:
                order.append(F.col(self.tie_breaker).asc())
            top = df.orderBy(*order).limit(self.shard_size)
            # rows at or below min_score rank last, so dropping them after the
            # limit equals dropping them before it
            return top.filter(as_col(self.score) > self.min_score) if self.min_score is not None else top
        digits = F.substring(F.md5(as_col(self.hash_field).cast("string")), 1, 8)
        return df.filter(F.conv(digits, 16, 10).cast("bigint") % F.lit(self.modulus) == 0)

    def run(self, df: DataFrame) -> DataFrame:
        return self.inner.run(self.sample(df))


def top_hits(df: DataFrame, by: Sequence[str], n: int, order: Sequence[Column]) -> DataFrame:
    """Best ``n`` rows per bucket with their ``rank`` (``order`` must end in a
    unique key), in two rounds (:func:`top_n_per_group`): a hot bucket is
    ranked by many tasks first."""
    return top_n_per_group(df, by, order, n, rank="rank")
