"""Tokenisation to word sets and set algebra inside a row.

The reference segments Chinese text with a dictionary segmenter. Here the
token set is a Catalyst expression (JVM-side, whole-stage codegen):

* ``whitespace``: split on runs of whitespace, drop empty pieces, distinct.
* ``cjk_char``: every Han character is a token; runs of other letters/digits
  form one token each.

A mode can also be a function of a column that gives ``array<string>``, such as
a user's own ``pandas_udf``; the set algebra below is the same. Words of
unspaced text need a dictionary, so they are no expression of a column:
``operators.segment``, token mode ``lattice`` of the matching modes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed patterns of the two native modes.
WHITESPACE_PATTERN = r"[ \t\n\x0B\f\r]+"
CJK_CHAR_PATTERN = r"(\p{IsHan}|[\p{L}\p{N}&&[^\p{IsHan}]]+)"

TOKEN_MODES = ("whitespace", "cjk_char")


def tokens(col: Column | str, mode: str | Callable[[Column], Column] = "whitespace") -> Column:
    """Distinct tokens of a string column; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    if callable(mode):
        pieces = mode(c)
    elif mode == "whitespace":
        pieces = F.split(c, WHITESPACE_PATTERN)
    elif mode == "cjk_char":
        pieces = F.regexp_extract_all(c, F.lit(CJK_CHAR_PATTERN), F.lit(1))
    else:
        raise ValueError(f"unknown token mode {mode!r}; use one of {TOKEN_MODES} or a callable")
    # The empty string never is a token: it stands for the empty set in joins.
    return F.array_distinct(F.filter(pieces, lambda t: t != F.lit("")))


def overlap(a: Column, b: Column) -> Column:
    """|A ∩ B| for two distinct-element arrays."""
    return F.size(F.array_intersect(a, b))


def substrings(col: Column, length: int) -> Column:
    """All substrings of ``length`` characters, distinct; empty if shorter."""
    n = F.length(col) - F.lit(length - 1)
    starts = F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(col, i, length)))
