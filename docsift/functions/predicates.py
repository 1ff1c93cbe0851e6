"""Composable, null-safe predicates (the query clauses of a search request).

A document whose field is missing does not match a clause, so ``not_(p)``
keeps it (document-store semantics, not SQL three-valued logic). A clause is
returned as a plain boolean ``Column``: inside a filter NULL and FALSE both
drop the row, so no ``coalesce`` is needed there, and only negation is
rewritten, as ``NOT p OR p IS NULL``. Keeping the conditions plain lets
Catalyst push the simple ones (term, terms, range, exists, prefix and their
negations) into the Parquet scan as ``PushedFilters``; a ``coalesce`` wrapper
would hide them from the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_col, null_safe
from .text import analyze, normalize


def match_all() -> Column:
    return F.lit(True)


def match_none() -> Column:
    return F.lit(False)


def term(field, value, case_insensitive: bool = False) -> Column:
    c = as_col(field)
    if case_insensitive and isinstance(value, str):
        return normalize(c) == value.lower()
    return c == F.lit(value)


def terms(field, values: Iterable, case_insensitive: bool = False) -> Column:
    values = list(values)
    c = as_col(field)
    if case_insensitive:
        return normalize(c).isin([v.lower() for v in values])
    return c.isin(values)


def range_(field, gt=None, gte=None, lt=None, lte=None) -> Column:
    """Range on numbers, strings or timestamps; bounds left as ``None`` are open."""
    c = as_col(field)
    conds = [c.isNotNull()]
    if gt is not None:
        conds.append(c > F.lit(gt))
    if gte is not None:
        conds.append(c >= F.lit(gte))
    if lt is not None:
        conds.append(c < F.lit(lt))
    if lte is not None:
        conds.append(c <= F.lit(lte))
    return _and(conds)


def exists(field) -> Column:
    return as_col(field).isNotNull()


def missing(field) -> Column:
    return as_col(field).isNull()


def ids(values: Iterable, id_field: str = "id") -> Column:
    """Documents whose id is in a (driver-side, hence bounded) list. For an id
    list that lives in a table use :func:`terms_lookup` instead."""
    return as_col(id_field).isin(list(values))


def prefix(field, value: str, case_insensitive: bool = False) -> Column:
    c = normalize(field) if case_insensitive else as_col(field)
    v = value.lower() if case_insensitive else value
    return c.startswith(v)


def wildcard_to_like(pattern: str) -> str:
    """``*`` = any run of characters, ``?`` = one character; everything else literal."""
    out = []
    for ch in pattern:
        if ch == "*":
            out.append("%")
        elif ch == "?":
            out.append("_")
        elif ch in "%_\\":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)


def wildcard(field, pattern: str, case_insensitive: bool = False) -> Column:
    c = normalize(field) if case_insensitive else as_col(field)
    p = pattern.lower() if case_insensitive else pattern
    return c.like(wildcard_to_like(p))


def regexp(field, pattern: str) -> Column:
    """The regular expression must match the whole value."""
    return as_col(field).rlike(rf"\A(?:{pattern})\z")


def fuzzy(field, value: str, max_edits: int = 2) -> Column:
    """Case-insensitive Levenshtein distance of the whole value <= ``max_edits``.
    The bounded form stops as soon as the distance exceeds ``max_edits``
    (it returns -1 then), so long values cost little."""
    d = F.levenshtein(F.lower(as_col(field)), F.lit(value.lower()), max_edits)
    return (d >= 0) & (d <= max_edits)


def _query_tokens(text: str) -> list[str]:
    return list(dict.fromkeys(analyze(text)))


# A token is a maximal run of letters/digits, so "token t is present" is the
# regex t with no letter or digit on either side; "t1 t2 consecutive" is t1,
# one or more other characters, t2. One regex scan of the lower-cased text,
# stopping at the first hit, replaces building and intersecting token arrays.
_WORD_EDGE_BEFORE = r"(?<![\p{L}\p{N}])"
_WORD_EDGE_AFTER = r"(?![\p{L}\p{N}])"
_GAP = r"[^\p{L}\p{N}]+"


def _words_regex(words: list[str]) -> str:
    alt = "|".join(re.escape(w) for w in words)
    return f"{_WORD_EDGE_BEFORE}(?:{alt}){_WORD_EDGE_AFTER}"


def _has_words(field, words: list[str]) -> Column:
    return F.lower(as_col(field)).rlike(_words_regex(words))


def _distinct_hits(field, words: list[str]) -> Column:
    """Number of distinct query words present, in one regex pass (only the
    matching words are extracted, never the whole token array)."""
    found = F.regexp_extract_all(F.lower(as_col(field)), F.lit(_words_regex(words)), 0)
    return F.size(F.array_distinct(found))


def match(field, text: str, operator: str = "or", minimum_should_match: int | None = None) -> Column:
    """Full-text match on tokens: ``or`` = any query token present, ``and`` =
    all present; ``minimum_should_match`` = at least that many distinct ones."""
    q = _query_tokens(text)
    if not q:
        return F.lit(False)
    if minimum_should_match is not None:
        if minimum_should_match <= 1:
            return _has_words(field, q)
        return _distinct_hits(field, q) >= minimum_should_match
    if operator == "or":
        return _has_words(field, q)
    if operator == "and":
        return _has_words(field, q) if len(q) == 1 else _distinct_hits(field, q) >= len(q)
    raise ValueError(f"unknown operator {operator!r}")


def match_phrase(field, text: str) -> Column:
    """Query tokens appear consecutively, in order."""
    q = analyze(text)
    if not q:
        return F.lit(False)
    body = _GAP.join(re.escape(w) for w in q)
    return F.lower(as_col(field)).rlike(f"{_WORD_EDGE_BEFORE}{body}{_WORD_EDGE_AFTER}")


def multi_match(fields: Sequence, text: str, operator: str = "or",
                minimum_should_match: int | None = None) -> Column:
    """The match holds in at least one of the fields."""
    out = F.lit(False)
    for f in fields:
        out = out | match(f, text, operator, minimum_should_match)
    return out


def holds_text(dtype: T.DataType) -> bool:
    """Text, or an array of it."""
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return isinstance(dtype, T.StringType)


def any_field(df: DataFrame, text: str, operator: str = "or") -> Column:
    """Free text over every field of text, arrays of text among them. For
    conditions on several fields see :func:`query_string`."""
    fields = [f.name for f in df.schema.fields if holds_text(f.dataType)]
    return on(df).multi_match(fields, text, operator) if fields else match_none()


def query_string(text: str, fields: Sequence[str] | None = None, operator: str = "or"):
    """A condition in the notation of :mod:`docsift.functions.query_string`,
    to be given to ``query``."""
    from .query_string import query_string as read
    return read(text, fields, operator)


def _and(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _or(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def bool_(must: Sequence[Column] = (), filter: Sequence[Column] = (),  # noqa: A002
          should: Sequence[Column] = (), must_not: Sequence[Column] = (),
          minimum_should_match: int | None = None) -> Column:
    """Boolean combination. ``should`` needs at least one match when there is
    no must/filter clause (or ``minimum_should_match`` when given)."""
    conds = list(must) + list(filter) + [not_(p) for p in must_not]
    if should:
        m = minimum_should_match
        if m is None:
            m = 0 if (must or filter) else 1
        if m == 1:
            conds.append(_or(list(should)))
        elif m > 1:
            n = sum((null_safe(p).cast("int") for p in should), F.lit(0))
            conds.append(n >= m)
    return _and(conds) if conds else F.lit(True)


def not_(p: Column) -> Column:
    """Document negation: true when ``p`` is false OR cannot be evaluated
    (missing field)."""
    return (~p) | p.isNull()


# Predicates on one field, and on several.
_ON_FIELD = ("term", "terms", "range_", "exists", "missing", "prefix", "wildcard", "regexp", "fuzzy", "match",
             "match_phrase")


def _part(name: str):
    return lambda x: x.getField(name)


class on:  # noqa: N801
    """The predicates bound to a frame, so that fields may hold several
    values: on an array (or a path into an array of objects) a clause holds if
    it does for any element. ``P.on(df).term("tags", "red")``; other clauses
    and plain fields are as in this module."""

    def __init__(self, df: DataFrame):
        self._df = df

    def _values(self, field):
        """The array of a field's elements, or None for a plain field."""
        dtype, ref, many = self._df.schema, None, False
        if not isinstance(field, str):
            return None
        for name in field.split("."):
            if isinstance(dtype, T.ArrayType):
                many = True
                if isinstance(dtype.elementType, T.ArrayType):
                    ref, dtype = F.flatten(ref), dtype.elementType
                element = dtype.elementType
                if not isinstance(element, T.StructType) or name not in element.names:
                    return None
                ref, dtype = F.transform(ref, _part(name)), T.ArrayType(element[name].dataType)
            elif isinstance(dtype, T.StructType) and name in dtype.names:
                ref = F.col(f"`{name}`") if ref is None else ref.getField(name)
                dtype = dtype[name].dataType
            else:
                return None
        while isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.ArrayType):
            ref, dtype, many = F.flatten(ref), dtype.elementType, True
        return ref if many or isinstance(dtype, T.ArrayType) else None

    def __getattr__(self, name: str):
        plain = globals()[name]
        if name == "multi_match":
            def several(fields, text, operator="or", minimum_should_match=None):
                return _or([self.match(f, text, operator, minimum_should_match) for f in fields])
            return several
        if name not in _ON_FIELD:
            return plain

        def bound(field, *args, **options):
            values = self._values(field)
            if values is None:
                return plain(field, *args, **options)
            if name == "missing":  # no element with a value
                return not_(F.exists(values, lambda x: x.isNotNull()))
            return F.exists(values, lambda x: null_safe(plain(x, *args, **options)))
        return bound


def nested(array_field, element_predicate) -> Column:
    """An array-of-struct field has at least one element satisfying the
    predicate (a function from the element Column to a boolean Column); the
    whole predicate is evaluated on one element at a time."""
    return null_safe(F.exists(as_col(array_field), lambda x: null_safe(element_predicate(x))))


def nested_flat(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                element_predicate: Column) -> DataFrame:
    """Same as :func:`nested` when the elements live in their own table (the
    normalised layout used at scale): a left-semi join, no arrays built."""
    # distinct keys first: a partial aggregate per task, so a parent with a
    # huge number of matching elements sends one row, not all of them
    keys = child.filter(element_predicate).select(F.col(child_key).alias(parent_key)).distinct()
    return parent.join(keys, on=parent_key, how="left_semi")


def terms_lookup(df: DataFrame, field: str, lookup: DataFrame, lookup_field: str) -> DataFrame:
    """Keep rows whose ``field`` value appears in ``lookup.lookup_field``.

    A left-semi join against the distinct lookup values (pre-aggregated, so a
    value repeated a billion times in the lookup is one row). Spark picks
    broadcast or sort-merge from statistics, AQE switches at runtime once the
    real size of the lookup side is known and splits a skewed key on the
    probe side."""
    keys = lookup.select(F.col(lookup_field).alias(field)).filter(F.col(field).isNotNull()).distinct()
    return df.join(keys, on=field, how="left_semi")


def sql(expr: str) -> Column:
    """Escape hatch: any Spark SQL boolean expression, made null-safe."""
    return null_safe(F.expr(expr))


def escape_regex(s: str) -> str:
    return re.escape(s)
