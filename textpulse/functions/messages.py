"""Typed reading of JSON fields through VARIANT.

VARIANT keeps JSON types apart, so that an object in a text field counts as missing instead
of turning up as its JSON text, and a message with a repeated key is rejected as a whole.
``document`` is the name of a variant column. The expressions are SQL text, which is one
call to the JVM for each field.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = "(BIGINT|DECIMAL|DOUBLE|FLOAT)"
_TEXT_LIKE = "(STRING|BIGINT|DECIMAL|DOUBLE|FLOAT)"


def parse_json(text: Column) -> Column:
    """A variant, or null for anything that is not one JSON value."""
    return F.try_parse_json(text)


def _get(document: str, path: str, kind: str) -> str:
    return f"try_variant_get({document}, '$.{path}', '{kind}')"


def _is(document: str, path: str, types: str) -> str:
    return f"schema_of_variant({_get(document, path, 'variant')}) rlike '^{types}'"


def text_field(document: str, name: str) -> Column:
    """A string, or the text of a number; anything else is an empty string."""
    value, usable = _get(document, name, "string"), _is(document, name, _TEXT_LIKE)
    return F.expr(f"coalesce(case when {usable} then {value} end, '')")


def number_field(document: str, name: str, kind: str) -> Column:
    """A number truncated to ``kind``; anything else, or out of range, is 0."""
    value, usable = _get(document, name, kind), _is(document, name, _NUMBER)
    return F.expr(f"coalesce(case when {usable} then {value} end, cast(0 as {kind}))")


def strict_text(document: str, path: str) -> Column:
    """A JSON string, else null."""
    value, usable = _get(document, path, "string"), _is(document, path, "STRING")
    return F.expr(f"case when {usable} then {value} end")


def strict_integer(document: str, path: str, kind: str) -> Column:
    """A whole JSON number that fits ``kind``, else null."""
    number, usable = _get(document, path, "double"), _is(document, path, _NUMBER)
    whole = f"{usable} and {number} = floor({number})"
    return F.expr(f"case when {whole} then {_get(document, path, kind)} end")
