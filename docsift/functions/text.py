"""Token and normalisation expressions shared by predicates, buckets and scoring.

All of these are built-in Spark expressions (JVM side, whole-stage codegen);
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import as_col

# Fixed value: a token is a maximal run of Unicode letters or digits taken
# from lower-cased text.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def normalize(c) -> Column:
    """Lower-case form used for case-insensitive matching (the ``keyword``
    tokenizer followed by a ``lowercase`` filter)."""
    return F.lower(as_col(c))


def tokens(c) -> Column:
    """Array of word tokens of a text column (duplicates kept, text order)."""
    return F.regexp_extract_all(F.lower(as_col(c)), F.lit(TOKEN_PATTERN), 0)


def distinct_tokens(c) -> Column:
    return F.array_distinct(tokens(c))


def analyze(text: str) -> list[str]:
    """Driver-side tokenizer for *query strings* given by the user (a few
    words), using the same rule as :func:`tokens`."""
    import regex

    return regex.findall(TOKEN_PATTERN, text.lower())
