"""Access to observation documents kept as JSON text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from gaugemill.constants import (
    HUMIDITY_KEY, PROBE_ARRAY_KEY, PROBE_KEY, TEMPERATURE_KEY,
)

# PostgreSQL-style row documents keep NULL fields and ISO timestamps with offset.
ROW_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ssxxx",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss",
}

# Values are kept as text: one that is no number must not spoil its neighbours.
READINGS_DOC = (
    f"{HUMIDITY_KEY} string, {TEMPERATURE_KEY} string, {PROBE_KEY} string, "
    f"{PROBE_ARRAY_KEY} array<map<string,string>>"
)


def text_of(doc: Column, key: str) -> Column:
    """Value of a top-level key as text; nested values as JSON text, null as NULL."""
    return F.get_json_object(doc, f"$['{key}']")


def has_value(doc: Column, key: str) -> Column:
    """Key present with a non-null value."""
    return text_of(doc, key).isNotNull()


def texts_of(doc: Column, keys: Iterable[str]) -> Column:
    """Struct of several keys as text, with one parse of the document."""
    return F.from_json(doc, ", ".join(f"{key} string" for key in keys))


def readings_of(doc: Column) -> Column:
    """Struct of all sensor readings as text, with one parse of the document."""
    return F.from_json(doc, READINGS_DOC)


def row_json(*columns: str | Column) -> Column:
    """One JSON document per row, in column order."""
    return F.to_json(F.struct(*columns), ROW_JSON_OPTIONS)


def json_member(key: Column, value: Column) -> Column:
    """``"key":value`` with the key escaped, for assembling a document in order."""
    doc = F.to_json(F.create_map(key, value))
    return F.substring(doc, F.lit(2), F.length(doc) - 2)


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()
