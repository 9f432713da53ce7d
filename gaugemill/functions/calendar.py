"""Calendar attributes of a date column."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from gaugemill.constants import CALENDAR_DAYS, CALENDAR_START


def _origin() -> Column:
    return F.lit(CALENDAR_START.isoformat()).cast("date")


def calendar_id_of(day: Column) -> Column:
    """Surrogate key of a date: 1 for the first calendar day."""
    return F.datediff(day, _origin()) + 1


def date_of(calendar_id: Column) -> Column:
    """Date behind a surrogate key."""
    return F.date_add(_origin(), calendar_id - 1)


def epoch_day(calendar_id: Column) -> Column:
    """Days from 1970-01-01 to the date behind a surrogate key."""
    return calendar_id.cast("long") + ((CALENDAR_START - date(1970, 1, 1)).days - 1)


def in_calendar(calendar_id: Column) -> Column:
    return calendar_id.between(1, CALENDAR_DAYS)


def iso_weekday(day: Column) -> Column:
    return F.weekday(day) + 1


def iso_year_week(day: Column) -> Column:
    """ISO year and week, e.g. 2019/01 for 2018-12-31."""
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), day).cast("string"),
        F.lit("/"),
        F.lpad(F.weekofyear(day).cast("string"), 2, "0"),
    )


def calendar_columns(day: Column) -> dict[str, Column]:
    """Derived attributes of the date dimension, in column order."""
    week_start = F.date_trunc("week", day).cast("date")
    return {
        "year": F.year(day),
        "month": F.month(day).cast("short"),
        "monthname": F.date_format(day, "MMMM"),
        "day": F.dayofmonth(day).cast("short"),
        "dayofyear": F.dayofyear(day),
        "weekdayname": F.date_format(day, "EEEE"),
        "calendarweek": F.weekofyear(day).cast("short"),
        "formatteddate": F.date_format(day, "dd/MM/yyyy"),
        "quartal": F.date_format(day, "'Q'Q"),
        "yearquartal": F.date_format(day, "yyyy/'Q'Q"),
        "yearmonth": F.date_format(day, "yyyy/MM"),
        "yearcalendarweek": iso_year_week(day),
        "weekend": F.when(iso_weekday(day) >= 6, "Weekend").otherwise("Weekday"),
        "cwstart": week_start,
        "cwend": F.date_add(week_start, 6),
        "monthstart": F.trunc(day, "MM"),
        "monthend": F.last_day(day),
    }
