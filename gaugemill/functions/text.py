"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Everything a right-strip of ASCII text removes.
TRAILING_SPACE = r"[ \t\n\r\f\x0B\x1C-\x1F]+$"


def strip_right(text: Column) -> Column:
    return F.regexp_replace(text, TRAILING_SPACE, "")


def strip(text: Column) -> Column:
    return F.regexp_replace(strip_right(text), r"^[ \t\n\r\f\x0B\x1C-\x1F]+", "")


def part(text: Column, separator: str, position: int) -> Column:
    """1-based part of a separated text; NULL when there are fewer parts."""
    pieces = F.split(text, f"\\Q{separator}\\E", -1)
    return F.try_element_at(pieces, F.lit(position))


def after_prefix(text: Column, prefix: str) -> Column:
    """Rest of the text behind the prefix; NULL when it does not start with it."""
    return F.when(text.startswith(prefix), F.substring(text, len(prefix) + 1, 2**31 - 1))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
