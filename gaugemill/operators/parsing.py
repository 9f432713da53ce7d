"""Sensor lines to typed readings, with a reason for every rejected line."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugemill.constants import PROBE_LINE_PREFIX
from gaugemill.functions import numeric, text

BAD_ENCODING = "bad_encoding"
NO_SEPARATOR = "no_separator"
NOT_NUMERIC = "not_numeric"
OUT_OF_RANGE = "out_of_range"


def drop_blank(lines: DataFrame) -> DataFrame:
    """Blank lines carry no reading and do not count towards a batch."""
    return lines.filter(F.length(F.rtrim(F.col("line"), F.lit("\r"))) > 0)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Split ``key:value[:ignored…]`` lines.

    Adds ``key``, ``node_unique_id`` (NULL for a plain key), ``value`` and
    ``reject_reason`` (NULL for a good line).  No line is dropped.
    """
    key = text.part(F.col("line"), ":", 1)
    raw_value = text.strip(text.part(F.col("line"), ":", 2))
    staged = lines.withColumns({"key": key, "_raw": raw_value}).withColumn(
        "value", numeric.to_number(F.col("_raw"))
    )
    reason = (
        F.when(~F.is_valid_utf8(F.col("line")), BAD_ENCODING)
        .when(F.col("_raw").isNull(), NO_SEPARATOR)
        .when(~F.col("_raw").rlike(numeric.NUMBER_PATTERN), NOT_NUMERIC)
        .when(F.col("value").isNull(), OUT_OF_RANGE)
    )
    return staged.withColumns(
        {
            "node_unique_id": text.after_prefix(F.col("key"), PROBE_LINE_PREFIX),
            "reject_reason": reason,
        }
    ).drop("_raw")


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull())
