"""Strict handling of untrusted JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRICT = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    # The parser's own limit would make very long texts look malformed.
    "maxStringLen": str(2**31 - 1),
}

# JSON's own white space; the regex class \s and the anchor $ admit more.
_SPACE = r"[ \t\r\n]*"

# An object that has no inner braces: if it parses, nothing can follow it.
_FLAT_OBJECT = rf"^{_SPACE}\{{[^{{}}]*\}}{_SPACE}\z"
_LAST_BRACE = rf"{_SPACE}\}}{_SPACE}\z"


def object_fields(text: Column) -> Column:
    """Top-level fields as a map of text values, NULL unless an object starts the text.

    Present keys with a JSON null have a NULL value.
    """
    return F.from_json(text, "map<string,string>", _STRICT)


def is_whole_object(text: Column, fields: Column) -> Column:
    """True if the text is one JSON object and nothing else.

    Spark's JSON readers stop after the first value, so trailing text has to be
    excluded separately. Flat objects are settled by one regular expression.
    Others are wrapped in an array, which only a `]` of their own can close
    early; with such a text they are wrapped in an object as well, because what
    closes one wrapper early breaks the other.
    """
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    in_object = F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    whole = text.rlike(_FLAT_OBJECT) | (in_array & (~text.contains("]") | in_object))
    return F.coalesce(fields.isNotNull() & whole, F.lit(False))


def has_field(fields: Column, *names: str) -> Column:
    """True if any of the names is a key, even with a null value."""
    found = F.map_contains_key(fields, names[0])
    for name in names[1:]:
        found = found | F.map_contains_key(fields, name)
    return found


def last_value(fields: Column, name: str) -> Column:
    """Value of the last entry of that name, NULL without one."""
    own = F.filter(F.map_entries(fields), lambda e: e["key"] == name)
    return F.try_element_at(own, F.lit(-1))["value"]


def add_fields(text: Column, additions: Column) -> Column:
    """Splice `, "key": value` text before the closing brace of a non-empty object.

    All original fields keep their exact text.
    """
    return F.concat(F.regexp_replace(text, _LAST_BRACE, ""), additions, F.lit("}"))
