"""Minute and quarter-hour summaries.

A quarter-hour is labelled ``HH:MM – HH:MM`` and ends at its last minute (:14, :29,
:44, :59).  Whether a window was delivered depends on the group key alone, so the
receipts are joined to the finished averages instead of to the readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.constants import HUMIDITY_KEY, PROBE_KEY, TEMPERATURE_KEY
from gaugemill.functions import calendar, clock, numeric, text
from gaugemill.operators import readings

WIDE_COLUMNS = ["observation_cnt", TEMPERATURE_KEY, HUMIDITY_KEY, PROBE_KEY]


def _valid(keyed: DataFrame) -> DataFrame:
    return keyed.filter(
        calendar.in_calendar(F.col("calendar_id")) & clock.in_day(F.col("time_id"))
    )


def _second() -> Column:
    return clock.second_behind(F.col("time_id"))


def _wide_aggregates(strict: bool) -> list[Column]:
    return [
        F.count_if("has_reading").cast("short" if strict else "int").alias("observation_cnt"),
        numeric.rounded_mean(F.col(TEMPERATURE_KEY), 1).alias(TEMPERATURE_KEY),
        numeric.rounded_mean(F.col(HUMIDITY_KEY), 0).alias(HUMIDITY_KEY),
        numeric.rounded_mean(F.col(PROBE_KEY), 1).alias(PROBE_KEY),
    ]


def minute_summary(keyed: DataFrame, strict_count: bool = False) -> DataFrame:
    """Count and means of the three scalar sensors per local date and minute."""
    wide = readings.wide_readings(_valid(keyed), ["calendar_id", "time_id"])
    grouped = wide.groupBy("calendar_id", clock.minute_of_day(_second()).alias("_minute")).agg(
        *_wide_aggregates(strict_count)
    ).filter(F.col("observation_cnt") > 0)
    minute = F.col("_minute")
    return grouped.select(
        calendar.date_of(F.col("calendar_id")).alias("datum"),
        clock.whole(minute, 60).alias("hour"),
        (minute % 60).alias("minute"),
        *WIDE_COLUMNS,
    )


def ordered_minute_summary(keyed: DataFrame) -> DataFrame:
    """For display only; rollups never sort."""
    return minute_summary(keyed).orderBy("datum", "hour", "minute")


def _quarters(keyed: DataFrame, groups: list[str], strict_count: bool) -> DataFrame:
    """Wide means per quarter-hour, with the quarter's first second for its labels."""
    wide = readings.wide_readings(_valid(keyed), ["calendar_id", "time_id", *groups])
    quarter = clock.quarter_first_minute(_second()).alias("_quarter")
    grouped = wide.groupBy("calendar_id", quarter, *groups).agg(
        *_wide_aggregates(strict_count)
    ).filter(F.col("observation_cnt") > 0)
    start = F.col("_quarter") * 60
    day = calendar.date_of(F.col("calendar_id"))
    return grouped.select(
        day.alias("datum"),
        clock.hour_part(start).alias("hour"),
        clock.quarter_label(start).alias("quarterhour"),
        *WIDE_COLUMNS,
        clock.quarter_end(day, start).alias("_local_end"),
        *groups,
    )


def quarter_summary(keyed: DataFrame, strict_count: bool = False) -> DataFrame:
    """Wide summary per local date and quarter-hour, whatever the zone."""
    return _quarters(keyed, [], strict_count).drop("_local_end")


def quarter_summary_zoned(keyed: DataFrame, strict_count: bool = False) -> DataFrame:
    """Wide summary per quarter-hour and zone, with the window's end as an instant."""
    end = clock.local_to_instant(F.col("_local_end"), F.col("timezone"))
    return _quarters(keyed, ["timezone"], strict_count).select(
        "datum", "hour", "quarterhour", *WIDE_COLUMNS, end.alias("end_15min"), "timezone"
    )


def submitted(key: str) -> Column:
    """1 when the left join found a receipt."""
    return F.when(F.col(key).isNotNull(), 1).otherwise(0)


def flag_submitted(windows: DataFrame, receipts: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Left join to distinct receipts; adds ``submitted_to_api``.

    ``keys`` maps receipt key columns to the window expressions they must equal.
    Receipts grow with the data and are not broadcast by hint; the windows side has
    one row per key, so neither side is skewed.
    """
    known = receipts.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).distinct()
    match = [expression == F.col(f"_r_{key}") for key, expression in keys.items()]
    first = next(iter(keys))
    joined = windows.join(known, match, "left")
    return joined.select(*windows.columns, submitted(f"_r_{first}").alias("submitted_to_api"))


def quarter_summary_flagged(keyed: DataFrame, receipts: DataFrame) -> DataFrame:
    """Zoned wide summary with the delivery flag of each window's end."""
    return flag_submitted(
        quarter_summary_zoned(keyed), receipts, {"end_15min": F.col("end_15min")}
    )


def _quarter_means(minute_fact: DataFrame, by_node: bool) -> DataFrame:
    """Two-decimal unweighted mean of the minute means per quarter-hour."""
    groups = ["sensor_name", "timezone", *(["node_unique_id"] if by_node else [])]
    quarter = clock.quarter_first_minute(_second()).alias("_quarter")
    means = _valid(minute_fact).groupBy("calendar_id", quarter, *groups).agg(
        numeric.rounded_mean(F.col("sensor_value"), 2).alias("sensor_value")
    )
    start = F.col("_quarter") * 60
    day = calendar.date_of(F.col("calendar_id"))
    return means.select(
        day.alias("datum"),
        clock.hour_part(start).alias("hour"),
        clock.quarter_label(start).alias("quarterhour"),
        "sensor_name",
        *(["node_unique_id"] if by_node else []),
        "timezone",
        clock.quarter_end(day, start).alias("end_15min"),
        "sensor_value",
    )


def _end_in_session_zone() -> Column:
    """The local label read in the session zone (UTC), as the stored receipts expect."""
    return F.col("end_15min").cast("timestamp")


def quarter_means(minute_fact: DataFrame, receipts: DataFrame) -> DataFrame:
    """Long quarter-hour summary per sensor, flagged by (end, sensor)."""
    return flag_submitted(
        _quarter_means(minute_fact, by_node=False),
        receipts,
        {"end_15min": _end_in_session_zone(), "sensor_name": F.col("sensor_name")},
    )


def quarter_means_by_node(
    minute_fact: DataFrame, receipts: DataFrame, zone_aware: bool = False
) -> DataFrame:
    """Long quarter-hour summary per sensor and node, flagged by (end, sensor, node).

    A missing node equals an empty one.  ``zone_aware`` compares the true instant of
    the window's end instead of its local label.
    """
    end = (
        clock.local_to_instant(F.col("end_15min"), F.col("timezone"))
        if zone_aware else _end_in_session_zone()
    )
    known = receipts.withColumn("node_unique_id", text.or_empty(F.col("node_unique_id")))
    return flag_submitted(
        _quarter_means(minute_fact, by_node=True),
        known,
        {
            "end_15min": end,
            "sensor_name": F.col("sensor_name"),
            "node_unique_id": text.or_empty(F.col("node_unique_id")),
        },
    )
