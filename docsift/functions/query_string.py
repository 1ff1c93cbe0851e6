"""Query strings: a short notation for predicates, compiled to one Column.

    status:open AND (title:"quick fox" OR body:jump*) -author.keyword:Bob price:[10 TO 20}

=====================  ====================================================
``word``               some default field holds the word
``field:word``         the field holds it (``a.b`` is a path; arrays: any element)
``"a phrase"``         its words, next to each other
``jump*``, ``j?mp``    a word of that form
``/jo[a-z]+/``         a word that matches the regular expression
``jump~``, ``jump~1``  a word within 2 (or 1) edits
``field:*``            the field has a value (also ``_exists_:field``)
``field:[a TO b}``     a range; ``[ ]`` include the end, ``{ }`` do not, ``*`` is open
``field:>=10``         a range with one end (``>``, ``>=``, ``<``, ``<=``)
``field:(a OR b)``     several conditions on one field
``a AND b``, ``&&``    both; binds closer than ``OR``, ``||``
``NOT a``, ``!a``      not (also where the field is missing)
``+a``, ``-a``         required, forbidden
=====================  ====================================================

Conditions next to each other are joined by ``operator``: with ``or`` (the
default) one must hold, unless some are required with ``+``; forbidden ones
must not hold in either case. A backslash takes the next character as it is.

Text is compared by lower-cased word tokens; ``field.keyword`` compares the
whole value as it is. Numbers, booleans and times compare by value, and a date
without a time of day is that whole day.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import predicates as P
from .text import analyze, tokens

# Characters that end a word unless escaped, and the notation of ranges.
_ENDS = ' \t\r\n()"[]{}:'
_COMPARE = ((">=", "gte"), ("<=", "lte"), (">", "gt"), ("<", "lt"))


class QueryStringError(ValueError):
    """A query string that cannot be read; ``place`` counts characters from 0."""

    def __init__(self, message: str, text: str, place: int):
        super().__init__(f"{message} at character {place}: {text[:place]}>>>{text[place:]}")
        self.place = place


@dataclass(frozen=True)
class Value:
    """``kind``: word, phrase, pattern, regexp, fuzzy, any, range."""
    kind: str
    text: str = ""
    edits: int = 0
    bounds: tuple[tuple[str, str], ...] = ()
    place: int = 0


@dataclass(frozen=True)
class Field:
    name: str | None
    value: Value
    place: int = 0


@dataclass(frozen=True)
class Group:
    """``kind``: and, or, not, list (conditions next to each other, each with
    its sign: ``+``, ``-`` or nothing)."""
    kind: str
    parts: tuple
    signs: tuple[str, ...] = ()


# ---------------------------------------------------------------- reading

class _Reader:
    def __init__(self, text: str):
        self.text, self.at = text, 0

    def fail(self, message: str, place: int | None = None):
        raise QueryStringError(message, self.text, self.at if place is None else place)

    def skip(self) -> str:
        while self.at < len(self.text) and self.text[self.at].isspace():
            self.at += 1
        return self.text[self.at: self.at + 1]

    def takes(self, *marks: str) -> bool:
        """Read one of the marks; words (AND, OR, NOT) must stand alone."""
        self.skip()
        for m in marks:
            end = self.at + len(m)
            if self.text.startswith(m, self.at) and not (m.isalpha() and self.text[end: end + 1] not in ("", *_ENDS.replace(":", ""))):
                self.at = end
                return True
        return False

    def whole(self, field: str | None) -> Group | Field:
        """Conditions up to the end or a closing bracket; AND before OR."""
        options = [self.row(field)]
        while self.takes("OR", "||"):
            options.append(self.row(field))
        return options[0] if len(options) == 1 else Group("or", tuple(options))

    def row(self, field: str | None):
        """Conditions next to each other, each perhaps a chain of ANDs."""
        parts, signs = [], []
        while True:
            sign = "+" if self.takes("+") else "-" if self.takes("-") else ""
            chain = [self.single(field)]
            while self.takes("AND", "&&"):
                chain.append(self.single(field))
            parts.append(chain[0] if len(chain) == 1 else Group("and", tuple(chain)))
            signs.append(sign)
            here = self.at
            if self.skip() in ("", ")") or self.takes("OR", "||"):
                self.at = here
                break
        if len(parts) == 1 and signs[0] != "-":
            return parts[0]
        return Group("list", tuple(parts), tuple(signs))

    def single(self, field: str | None):
        if self.takes("NOT", "!"):
            return Group("not", (self.single(field),))
        c = self.skip()
        if c in ("", ")"):
            self.fail("a condition is missing")
        here = self.at
        if self.takes("AND", "OR", "&&", "||"):
            self.fail("a condition is missing before the operator", here)
        if c == "(":
            return self.group(field)
        place = self.at
        if c not in '"/[{<>' and field is None:
            name = self.word()
            if name and self.text[self.at: self.at + 1] == ":":
                self.at += 1
                name = re.sub(r"\\(.)", r"\1", name)
                if self.skip() == "(":
                    return self.group(name)
                if name == "_exists_":
                    return Field(self.plain("a field"), Value("any"), place)
                return Field(name, self.value(), place)
            self.at = place
        return Field(field, self.value(), place)

    def group(self, field: str | None):
        start = self.at
        self.at += 1
        out = self.whole(field)
        if not self.takes(")"):
            self.fail("the bracket is not closed", start)
        return out

    def word(self) -> str:
        """Characters up to a blank or a sign, escapes kept."""
        start = self.at
        while self.at < len(self.text) and self.text[self.at] not in _ENDS:
            self.at += 2 if self.text[self.at] == "\\" else 1
        if self.at > len(self.text):
            self.fail("nothing follows the backslash", len(self.text) - 1)
        return self.text[start: self.at]

    def plain(self, what: str) -> str:
        self.skip()
        out = self.word()
        if not out:
            self.fail(f"{what} is missing")
        return re.sub(r"\\(.)", r"\1", out)

    def quoted(self, mark: str) -> str:
        start = self.at
        end = start + 1
        while end < len(self.text) and self.text[end] != mark:
            end += 2 if self.text[end] == "\\" else 1
        if end >= len(self.text):
            self.fail("the phrase is not closed" if mark == '"' else "the expression is not closed", start)
        self.at = end + 1
        return self.text[start + 1: end]

    def value(self) -> Value:
        c, place = self.skip(), self.at
        if c in "([{" and c:
            return self.range_()
        if c == '"':
            return Value("phrase", re.sub(r"\\(.)", r"\1", self.quoted('"')), place=place)
        if c == "/":
            return Value("regexp", self.quoted("/").replace("\\/", "/"), place=place)
        for mark, bound in _COMPARE:
            if self.takes(mark):
                self.skip()
                end = self.quoted('"') if self.text[self.at: self.at + 1] == '"' else self.time_or_plain()
                return Value("range", bounds=((bound, end),), place=place)
        raw = self.time_or_raw()
        if not raw:
            self.fail("a value is missing")
        if raw == "*":
            return Value("any", place=place)
        fuzzy = re.fullmatch(r"(.*[^\\])~(\d*)", raw, re.S)
        if fuzzy:
            return Value("fuzzy", re.sub(r"\\(.)", r"\1", fuzzy[1]), int(fuzzy[2] or 2), place=place)
        if re.search(r"(?<!\\)(?:\\\\)*[*?]", raw):
            return Value("pattern", raw, place=place)
        return Value("word", re.sub(r"\\(.)", r"\1", raw), place=place)

    def time_or_raw(self) -> str:
        """A word; colons of a time of day belong to it."""
        time = re.compile(r"\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d+)?)?").match(self.text, self.at)
        if time:
            self.at = time.end()
            return time[0]
        return self.word()

    def time_or_plain(self) -> str:
        out = re.sub(r"\\(.)", r"\1", self.time_or_raw())
        if not out:
            self.fail("a value is missing")
        return out

    def range_(self) -> Value:
        start = self.at
        low = {"[": "gte", "{": "gt"}.get(self.text[self.at])
        if low is None:
            self.fail("a value is missing")
        self.at += 1
        ends = []
        for _ in range(2):
            self.skip()
            ends.append(self.quoted('"') if self.text[self.at: self.at + 1] == '"' else self.time_or_plain())
            if len(ends) == 1 and not self.takes("TO"):
                self.fail("TO is missing in the range", start)
        high = {"]": "lte", "}": "lt"}.get(self.skip())
        if high is None:
            self.fail("the range is not closed", start)
        self.at += 1
        bounds = tuple((b, e) for b, e in ((low, ends[0]), (high, ends[1])) if e != "*")
        return Value("range", bounds=bounds, place=start)


def parse(text: str) -> Group | Field | None:
    """The conditions of a query string; None if it is blank or ``*``."""
    reader = _Reader(text)
    if reader.skip() == "" or text.strip() in ("*", "*:*"):
        return None
    out = reader.whole(None)
    if reader.skip():
        reader.fail("unexpected character")
    return out


# ---------------------------------------------------------------- columns

def _form(pattern: str) -> str:
    """A wildcard pattern as a regular expression over the letters of a word."""
    letter, out, i = r"[\p{L}\p{N}]", [], 0
    pattern = pattern.lower()
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            out.append(re.escape(pattern[i]))
        else:
            out.append({"*": f"{letter}*", "?": letter}.get(c) or re.escape(c))
        i += 1
    return "".join(out)


class _Compiler:
    def __init__(self, bound: P.on, text: str, fields: Sequence[str] | None, operator: str):
        self.on, self.text, self.operator = bound, text, operator
        schema = bound._df.schema
        self.default = list(fields) if fields is not None else [f.name for f in schema.fields if P.holds_text(f.dataType)]

    def of(self, node) -> Column:
        if isinstance(node, Field):
            return self.field(node)
        parts = [self.of(p) for p in node.parts]
        if node.kind == "not":
            return P.not_(parts[0])
        if node.kind in ("and", "or"):
            return reduce((lambda a, b: a & b) if node.kind == "and" else (lambda a, b: a | b), parts)
        must = [p for p, s in zip(parts, node.signs) if s == "+"]
        free = [p for p, s in zip(parts, node.signs) if s == ""]
        never = [p for p, s in zip(parts, node.signs) if s == "-"]
        if self.operator == "and":
            return P.bool_(must=must + free, must_not=never)
        # with required conditions the free ones change nothing
        return P.bool_(must=must, should=[] if must else free, must_not=never)

    def field(self, node: Field) -> Column:
        if node.name is None:
            if not self.default:
                raise QueryStringError("no default field", self.text, node.place)
            return reduce(lambda a, b: a | b, [self.one(f, node) for f in self.default])
        return self.one(node.name, node)

    def one(self, name: str, node: Field) -> Column:
        from ..plans.search import type_at
        exact = name.endswith(".keyword") and type_at(self.on._df.schema, name) is None
        path = name.removesuffix(".keyword") if exact else name
        dtype = type_at(self.on._df.schema, path)
        if dtype is None:
            raise QueryStringError(f"no field {name!r}", self.text, node.place)
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        v = node.value
        if v.kind == "any":
            return P.not_(self.on.missing(path))
        if isinstance(dtype, T.StringType):
            return self.exact(path, v) if exact or v.kind == "range" else self.tokens(path, v)
        return self.typed(path, dtype, v)

    def each(self, path: str, test) -> Column:
        """``test`` of the field, or of any element of an array."""
        values = self.on._values(path)
        return test(F.col(path)) if values is None else F.exists(values, lambda x: P.null_safe(test(x)))

    def exact(self, path: str, v: Value) -> Column:
        if v.kind == "range":
            return self.on.range_(path, **dict(v.bounds))
        if v.kind == "pattern":
            return self.on.wildcard(path, v.text)
        if v.kind in ("regexp", "fuzzy"):
            return self.on.regexp(path, v.text) if v.kind == "regexp" else self.on.fuzzy(path, v.text, v.edits)
        return self.on.term(path, v.text)

    def tokens(self, path: str, v: Value) -> Column:
        if v.kind in ("pattern", "regexp"):
            form = _form(v.text) if v.kind == "pattern" else f"(?:{v.text})"
            if v.kind == "regexp":  # its dots and classes stay inside one word
                return self.each(path, lambda x: F.exists(tokens(x), lambda w: w.rlike(rf"\A{form}\z")))
            return self.each(path, lambda x: F.lower(x).rlike(rf"(?<![\p{{L}}\p{{N}}]){form}(?![\p{{L}}\p{{N}}])"))
        if v.kind == "fuzzy":
            return self.each(path, lambda x: F.exists(tokens(x), lambda w: P.fuzzy(w, v.text, v.edits)))
        if not analyze(v.text):
            return F.lit(False)  # a value without words is held by no text
        return self.on.match_phrase(path, v.text)

    def typed(self, path: str, dtype: T.DataType, v: Value) -> Column:
        time = isinstance(dtype, (T.TimestampType, T.TimestampNTZType))

        def read(text: str) -> tuple[Column, bool]:
            """The value, and whether it is a whole day."""
            whole = time and re.fullmatch(r"\d{4}-\d\d-\d\d", text) is not None
            ok = (isinstance(dtype, T.BooleanType) and text.lower() in ("true", "false")
                  or isinstance(dtype, T.NumericType) and re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text)
                  or (time or isinstance(dtype, T.DateType)) and re.fullmatch(r"\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d+)?)?)?", text))
            if not ok:
                raise QueryStringError(f"{text!r} is no value of the type {dtype.simpleString()}", self.text, v.place)
            # fractions are compared with whole numbers as they are
            wide = "decimal(38,10)" if isinstance(dtype, T.IntegralType) else dtype
            return F.lit(text).cast(wide), whole

        def test(x: Column) -> Column:
            out = x.isNotNull()
            for bound, text in v.bounds:
                end, day = read(text)
                if day and bound in ("lte", "gt"):
                    end, bound = end + F.expr("INTERVAL 1 DAY"), {"lte": "lt", "gt": "gte"}[bound]
                out = out & {"gte": x >= end, "gt": x > end, "lte": x <= end, "lt": x < end}[bound]
            return out

        if v.kind == "range":
            return self.each(path, test)
        if v.kind not in ("word", "phrase"):
            raise QueryStringError(f"a {v.kind} cannot be asked of the type {dtype.simpleString()}", self.text, v.place)
        value, day = read(v.text)
        if day:
            return self.each(path, lambda x: (x >= value) & (x < value + F.expr("INTERVAL 1 DAY")))
        return self.each(path, lambda x: x == value)


def query_string(text: str, fields: Sequence[str] | None = None, operator: str = "or"):
    """A condition for :func:`docsift.plans.search.query`, written as a query
    string. ``fields``: where words without a field are looked for (default: all
    text fields of the frame, arrays of text among them). A string that cannot
    be read raises at once, one that does not fit the frame when it is used;
    both name the place."""
    if operator not in ("or", "and"):
        raise ValueError(f"operator must be or or and, got {operator!r}")
    found = parse(text)

    def condition(bound: P.on) -> Column:
        return F.lit(True) if found is None else _Compiler(bound, text, fields, operator).of(found)

    return condition
