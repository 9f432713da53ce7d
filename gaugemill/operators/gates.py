"""Row predicates on the clock and on the imported flag.

Bounds are computed once and compared with the bare column, so they reach the scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.constants import RETENTION_HOURS
from gaugemill.functions import calendar, clock

GUARD_MINUTES = 2
MINUTES_PER_DAY = 1440


def _type(df: DataFrame, column: str):
    return df.schema[column].dataType


def before_open_minute(df: DataFrame, as_of: datetime, ts: str = "observe_date") -> Column:
    """The row's minute is over: trunc(ts) < trunc(as_of), written on the bare column."""
    return F.col(ts) < clock.instant(clock.start_of_minute(as_of), _type(df, ts))


def closed_minutes(raw: DataFrame, as_of: datetime) -> DataFrame:
    return raw.filter(before_open_minute(raw, as_of))


def not_imported(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("imported"))


def expired(df: DataFrame, as_of: datetime, hours: int = RETENTION_HOURS) -> Column:
    """Imported and older than the retention time."""
    bound = clock.instant(clock.hours_before(as_of, hours), _type(df, "observe_date"))
    return F.col("imported") & (F.col("observe_date") < bound)


def closed_local_minute(as_of: datetime, wrap: bool = False) -> Column:
    """The keyed row's minute, plus a guard of two minutes, is over in its own zone.

    Earlier local dates are closed.  With ``wrap`` the guard wraps at midnight and any
    other date counts as closed, future dates included.  All is compared in whole
    minutes, so the zone of a row is converted once.
    """
    local_now = F.from_utc_timestamp(clock.instant(as_of), F.col("timezone"))
    now = F.call_function("div", F.unix_micros(local_now), F.lit(60_000_000))
    day_start = calendar.epoch_day(F.col("calendar_id")) * MINUTES_PER_DAY
    minute = clock.minute_of_day(clock.second_behind(F.col("time_id")))
    guarded = minute + GUARD_MINUTES
    if wrap:
        today = now - now % MINUTES_PER_DAY
        return (day_start != today) | (guarded % MINUTES_PER_DAY < now % MINUTES_PER_DAY)
    # Cut at the last minute of the day: earlier days stay closed, today's last
    # minutes stay open.
    return day_start + F.least(guarded, F.lit(MINUTES_PER_DAY - 1)) < now


def eligible(keyed: DataFrame, as_of: datetime, wrap: bool = False) -> DataFrame:
    """Keyed rows to roll up: valid keys, not imported, minute closed in the row's zone."""
    return keyed.filter(
        ~F.col("imported")
        & calendar.in_calendar(F.col("calendar_id"))
        & clock.in_day(F.col("time_id"))
        & closed_local_minute(as_of, wrap)
    )


def elapsed(windows: DataFrame, as_of: datetime, grace_minutes: int = 0) -> DataFrame:
    """Windows whose end label, plus a grace, lies before ``as_of``."""
    bound = clock.naive_utc(as_of) - timedelta(minutes=grace_minutes)
    return windows.filter(F.col("end_15min") < clock.instant(bound, _type(windows, "end_15min")))
