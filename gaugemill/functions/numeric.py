"""Decimal arithmetic on readings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gaugemill.constants import READING_TYPE

# Plain decimal notation; the pattern keeps out nan, infinity, digit-group
# underscores and type suffixes, on which casts of different engines disagree.
NUMBER_PATTERN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def to_number(text: Column, type_name: str = READING_TYPE) -> Column:
    """Text to decimal; NULL where the text is no finite number or out of range."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast(type_name))


def mean_of(total: Column, count: Column) -> Column:
    """Mean of mergeable partials; 16 decimals, NULL for an empty group."""
    return F.when(count > 0, total / count.cast("decimal(14,0)"))


def mean(value: Column) -> Column:
    """Aggregate: exact decimal mean, NULL values ignored.

    ``avg`` of a decimal keeps four extra digits only; sum over count keeps 16
    decimals, so a later rounding never sees an already rounded tie.
    """
    return mean_of(F.sum(value), F.count(value))


def rounded_mean(value: Column, digits: int) -> Column:
    """Aggregate: mean rounded half away from zero."""
    return F.round(mean(value), digits)


def small_count(strict: bool = False) -> Column:
    """Aggregate: row count; ``strict`` keeps the 16-bit type and its overflow error."""
    return F.count(F.lit(1)).cast("short" if strict else "int")


def to_fahrenheit(celsius: Column) -> Column:
    """Degrees C to F in decimal arithmetic, two decimals, NULL for non-numbers."""
    exact = celsius.cast("decimal(14,6)") * F.lit("1.8").cast("decimal(2,1)")
    return F.round(exact + F.lit(32), 2)
