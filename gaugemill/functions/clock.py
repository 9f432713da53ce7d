"""Time of day, minute and quarter-hour windows, and time zones.

Time of day is an integer second of the day throughout, so keys are compared and
grouped as integers and turned into text only for display.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F, types as T

from gaugemill.constants import (
    DAY_PART_OTHERWISE, DAY_PARTS, DAYLIGHT, QUARTER_SEPARATOR, SECONDS_PER_DAY,
)


# ---- instants given by the caller ---------------------------------------------

def naive_utc(moment: datetime) -> datetime:
    """The moment as naive UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def instant(moment: datetime, like: T.DataType | None = None) -> Column:
    """Literal of the same timestamp type as a column.

    With equal types the comparison needs no cast of the column and reaches the scan.
    """
    text = naive_utc(moment).isoformat(sep=" ")
    if isinstance(like, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "+00:00").cast("timestamp")


def start_of_minute(moment: datetime) -> datetime:
    return naive_utc(moment).replace(second=0, microsecond=0)


def hours_before(moment: datetime, hours: int) -> datetime:
    return naive_utc(moment) - timedelta(hours=hours)


# ---- truncation ---------------------------------------------------------------

def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def second_of(ts: Column) -> Column:
    return F.date_trunc("second", ts)


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


# ---- second of day -> parts and labels ----------------------------------------

def time_id_of(second: Column) -> Column:
    """Surrogate key of a second of the day: 1 for midnight."""
    return second + 1


def second_behind(time_id: Column) -> Column:
    return time_id - 1


def in_day(time_id: Column) -> Column:
    return time_id.between(1, SECONDS_PER_DAY)


def whole(dividend: Column, divisor: int) -> Column:
    """Integer quotient of integers."""
    return F.call_function("div", dividend, F.lit(divisor)).cast("int")


def hour_part(second: Column) -> Column:
    return whole(second, 3600)


def minute_part(second: Column) -> Column:
    return whole(second, 60) % 60


def minute_of_day(second: Column) -> Column:
    return whole(second, 60)


def minute_start(second: Column) -> Column:
    """Second of the day at which the minute starts."""
    return second - second % 60


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def hhmm(minute: Column) -> Column:
    """``HH:MM`` of a minute of the day."""
    return F.concat(_two(whole(minute, 60)), F.lit(":"), _two(minute % 60))


def hhmmss(second: Column) -> Column:
    return F.concat(hhmm(minute_of_day(second)), F.lit(":"), _two(second % 60))


def quarter_first_minute(second: Column) -> Column:
    minute = minute_of_day(second)
    return minute - minute % 15


def quarter_last_minute(second: Column) -> Column:
    """Windows are labelled by their last minute (:14, :29, :44, :59)."""
    return quarter_first_minute(second) + 14


def quarter_label(second: Column) -> Column:
    return F.concat(
        hhmm(quarter_first_minute(second)),
        F.lit(QUARTER_SEPARATOR),
        hhmm(quarter_last_minute(second)),
    )


def quarter_end(day: Column, second: Column) -> Column:
    """Local timestamp of the last minute of the quarter-hour."""
    return at_second(day, quarter_last_minute(second) * 60)


def day_part(second: Column) -> Column:
    label = hhmm(minute_of_day(second))
    out = None
    for first, last, name in DAY_PARTS:
        inside = label.between(first, last)
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out.otherwise(DAY_PART_OTHERWISE)


def day_or_night(second: Column) -> Column:
    label = hhmm(minute_of_day(second))
    return F.when(label.between(*DAYLIGHT), "Day").otherwise("Night")


def time_columns(second: Column) -> dict[str, Column]:
    """Derived attributes of the time-of-day dimension, in column order."""
    return {
        "timeofday": hhmmss(second),
        "hour": hour_part(second).cast("short"),
        "minute": minute_part(second).cast("short"),
        "second": (second % 60).cast("short"),
        "quarterhour": quarter_label(second),
        "daytimename": day_part(second),
        "daynight": day_or_night(second),
    }


# ---- dates, times and zones ---------------------------------------------------

def at_second(day: Column, second: Column) -> Column:
    """Date plus second of day as a local timestamp."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), second.cast("decimal(18,6)")
    )


def local_to_instant(local: Column, zone: Column) -> Column:
    """Local timestamp in a named zone to the instant it denotes."""
    return F.to_utc_timestamp(local.cast("timestamp"), zone)


def instant_to_local(ts: Column, zone: Column) -> Column:
    """Instant to the local timestamp in a named zone."""
    return F.from_utc_timestamp(ts, zone).cast("timestamp_ntz")


def plus_minutes(ts: Column, minutes: int) -> Column:
    return ts + F.make_dt_interval(mins=F.lit(minutes))
