"""Observations under date and time-of-day keys: star join, lookups, minute rollup.

Surrogate keys follow from date and second by arithmetic, so rollups group by key
arithmetic and need no dimension join; the joins are offered where their columns are
the result.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from gaugemill.functions import clock, numeric
from gaugemill.operators import gates, readings

KEYS = ("calendar_id", "time_id", "timezone")
MINUTE_KEY = ("calendar_id", "time_id", "timezone", "sensor_name", "node_unique_id")


def star_view(keyed: DataFrame, dates: DataFrame, times: DataFrame) -> DataFrame:
    """Observations with their date and time attributes."""
    dates = dates.select("calendar_id", "datum", "formatteddate", "year", "month")
    times = times.select(
        "time_id", "timeofday", "hour", "minute", "daytimename", "daynight", "quarterhour"
    )
    return (
        keyed.select("calendar_id", "time_id", "timezone", "sensor_values")
        .join(F.broadcast(dates), "calendar_id")
        .join(F.broadcast(times), "time_id")
        .select(
            clock.at_second(F.col("datum"), clock.second_behind(F.col("time_id"))).alias("tstamp"),
            "datum", "formatteddate", "year", "month", "timeofday", "hour", "minute",
            "daytimename", "daynight", "quarterhour", "timezone", "sensor_values",
        )
    )


def _lookup_keys(incoming: DataFrame) -> DataFrame:
    """Date and second (fraction cut off) of the incoming local timestamp."""
    return incoming.withColumns(
        {
            "_datum": F.col("obs_time").cast("date"),
            "_timeofday": F.date_format(clock.second_of(F.col("obs_time")), "HH:mm:ss"),
        }
    )


def key_lookup(incoming: DataFrame, dates: DataFrame, times: DataFrame) -> DataFrame:
    """Surrogate keys of incoming rows; rows outside the dimensions are dropped."""
    days = F.broadcast(dates.select("calendar_id", F.col("datum").alias("_datum")))
    seconds = F.broadcast(times.select("time_id", F.col("timeofday").alias("_timeofday")))
    return (
        _lookup_keys(incoming)
        .join(days, "_datum")
        .join(seconds, "_timeofday")
        .select(*[c for c in incoming.columns if c != "obs_time"], "calendar_id", "time_id")
    )


def key_rejects(incoming: DataFrame, dates: DataFrame) -> DataFrame:
    """Incoming rows whose date is not in the date dimension (every second always is)."""
    days = F.broadcast(dates.select(F.col("datum").alias("_datum")))
    return _lookup_keys(incoming).join(days, "_datum", "left_anti").select(*incoming.columns)


def minute_key(time_id: str = "time_id"):
    """Key of the first second of the minute."""
    return clock.time_id_of(clock.minute_start(clock.second_behind(F.col(time_id))))


def minute_rollup(keyed: DataFrame, as_of: datetime, wrap: bool = False) -> DataFrame:
    """Two-decimal mean per minute, zone, sensor and node of the eligible rows.

    Equal readings of one second count once.  Both aggregations are reduced in
    every task before they are shuffled.
    """
    rows = gates.eligible(keyed, as_of, wrap)
    return roll_up(readings.distinct_readings(rows, KEYS))


def roll_up(detail: DataFrame) -> DataFrame:
    """Mean per minute of distinct per-second readings."""
    minutes = detail.withColumn("time_id", minute_key())
    return minutes.groupBy(*MINUTE_KEY).agg(
        numeric.rounded_mean(F.col("sensor_value"), 2).alias("sensor_value")
    )


def eligible_rows(keyed: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is in a given id relation, each once."""
    return keyed.join(ids.select("observation_id").distinct(), "observation_id", "left_semi")


def probe_rows_of(keyed: DataFrame, ids: DataFrame) -> DataFrame:
    """Scalar probe readings of given ids, without known-bad values."""
    rows = eligible_rows(keyed, ids)
    detail = readings.wide_readings(rows, ["observation_id", *KEYS])
    return detail.filter(readings.not_bad(F.col("ds18b20_t"))).drop("has_reading")


def loaded_minutes(minute_fact: DataFrame) -> DataFrame:
    """Distinct (date, minute) of the minute fact."""
    return minute_fact.select("calendar_id", minute_key().alias("time_id")).distinct()
