"""Synthetic observations.

Random draws are hashes of the row number and a seed, not a task-local generator:
a repeated or differently split task yields the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugemill.constants import (
    SYNTHETIC_DAYS, SYNTHETIC_PAYLOAD, SYNTHETIC_ROWS_PER_WEEK, SYNTHETIC_SECONDS,
    SYNTHETIC_START, SYNTHETIC_STEP_S, SYNTHETIC_ZONE,
)


def uniform_ppm(number: Column, seed: int, draw: str) -> Column:
    """Uniform integer in [0, 1 000 000) from a row number."""
    digest = F.md5(F.concat_ws(":", F.lit(f"{seed}:{draw}"), number.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") % 1_000_000


def row_numbers(spark: SparkSession, scale: int = 1) -> DataFrame:
    """1 … rows of ``scale`` weeks."""
    return spark.range(1, SYNTHETIC_ROWS_PER_WEEK * scale + 1).withColumnRenamed("id", "n")


def regular_observations(numbers: DataFrame, seed: int = 42) -> DataFrame:
    """One reading every ten seconds, jittered: step · (n + 1.5·u − v), u and v uniform."""
    n = F.col("n")
    jitter_us = (
        uniform_ppm(n, seed, "late") * 3 - uniform_ppm(n, seed, "early") * 2
    ) * SYNTHETIC_STEP_S
    start = F.unix_micros(F.lit(SYNTHETIC_START + "+00:00").cast("timestamp"))
    # 1.5·u − v in halves of a millionth, times the step in seconds
    micros = start + n * SYNTHETIC_STEP_S * 1_000_000 + F.call_function("div", jitter_us, F.lit(2))
    return numbers.select(
        n.alias("id"),
        F.timestamp_micros(micros).alias("observe_date"),
        F.lit(SYNTHETIC_PAYLOAD).alias("sensor_values"),
    )


def keyed_observations(numbers: DataFrame, seed: int = 42) -> DataFrame:
    """Readings at random dates of a year and random seconds of the day, as keys."""
    n = F.col("n")

    def up_to(limit: int, draw: str) -> Column:
        scaled = uniform_ppm(n, seed, draw) * limit
        return (F.call_function("div", scaled, F.lit(1_000_000)) + 1).cast("int")

    return numbers.select(
        n.alias("observation_id"),
        up_to(SYNTHETIC_DAYS, "day").alias("calendar_id"),
        up_to(SYNTHETIC_SECONDS, "second").alias("time_id"),
        F.lit(SYNTHETIC_ZONE).alias("timezone"),
        F.lit(SYNTHETIC_PAYLOAD).alias("sensor_values"),
        F.lit(False).alias("imported"),
    )
