"""Typed leaf access on parsed JSON (X1-X5), as VARIANT expressions.

The log text is parsed once with ``try_parse_json`` (NULL for text that is
not JSON or holds a duplicate key; text after the first value is ignored).
Leaves are then read with a type check, mirroring strict getters:

* string leaf: only a JSON string; anything else (number, null, missing) -> NULL
* int / long leaf: a number (fraction cut toward zero) or a numeric string;
  booleans and other text -> NULL
* objects are read with one cast to ``struct<name: variant, ...>`` (NULL
  when the value is not an object); arrays with a cast to ``array<variant>``
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(text: Column) -> Column:
    return F.try_parse_json(text)


def object_fields(v: Column, names) -> Column:
    """Cast an object to ``struct<name: variant, ...>`` in one pass.

    NULL when ``v`` is not an object (so it is also the object test); a
    missing member is a NULL field. Member names match exactly.
    """
    ddl = "struct<" + ",".join(f"`{n}`:variant" for n in names) + ">"
    return F.try_variant_get(v, "$", ddl)


def string_value(x: Column) -> Column:
    """A leaf VARIANT that is a JSON string, else NULL."""
    return F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))


def integral_value(x: Column, sql_type: str = "bigint") -> Column:
    """A number (fraction cut toward zero) or numeric string, else NULL.

    A boolean is the only other value that casts to a number, to 0 or 1: those
    are looked at again, and they are no number if they read as true or false.
    """
    n = F.try_variant_get(x, "$", sql_type)
    return F.when(~n.isin(0, 1) | ~F.try_variant_get(x, "$", "string").isin("true", "false"), n)


def missing(x: Column) -> Column:
    """Absent, or JSON null."""
    return x.isNull() | F.is_variant_null(x)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def first_null_index(arr: Column) -> Column:
    """1-based position of the first NULL element, 0 if none."""
    return F.array_position(F.transform(arr, lambda a: a.isNull()), True)
