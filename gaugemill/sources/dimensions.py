"""Generated date and time-of-day dimensions, and the sensor catalogue.

All three have a fixed size, so broadcasting them is always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugemill.constants import (
    CALENDAR_DAYS, NODE_MODELS, SECONDS_PER_DAY, VALUE_TYPES, VALUE_UNITS,
)
from gaugemill.functions import calendar, clock


def calendar_dimension(spark: SparkSession) -> DataFrame:
    """One row per day from the first calendar day on."""
    days = spark.range(1, CALENDAR_DAYS + 1).select(
        F.col("id").cast("int").alias("calendar_id"),
        calendar.date_of(F.col("id").cast("int")).alias("datum"),
    )
    return days.withColumns(calendar.calendar_columns(F.col("datum")))


def time_dimension(spark: SparkSession) -> DataFrame:
    """One row per second of the day."""
    seconds = spark.range(SECONDS_PER_DAY).select(F.col("id").cast("int").alias("_second"))
    return seconds.select(
        clock.time_id_of(F.col("_second")).alias("time_id"),
        *[c.alias(n) for n, c in clock.time_columns(F.col("_second")).items()],
    )


def _seed(spark: SparkSession, rows, columns: str) -> DataFrame:
    """Literal rows as a local relation: planned and counted without a job."""
    rows_sql = ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in row) + ")"
        for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {rows_sql} AS seed({columns})")


def value_types(spark: SparkSession) -> DataFrame:
    return _seed(spark, VALUE_TYPES, "id, name").select(F.col("id").cast("long"), "name")


def value_units(spark: SparkSession) -> DataFrame:
    return _seed(spark, VALUE_UNITS, "id, name").select(F.col("id").cast("long"), "name")


def node_models(spark: SparkSession) -> DataFrame:
    """Sensor catalogue: which observation key belongs to which model, type and unit.

    Seed rows name their type and unit, which gives the same pairs as filtering the
    product of the two seed tables by name.
    """
    type_ids = {name: key for key, name in VALUE_TYPES}
    unit_ids = {name: key for key, name in VALUE_UNITS}
    rows = [
        (key, name, column, type_ids[type_name], unit_ids[unit_name])
        for key, name, column, type_name, unit_name in NODE_MODELS
    ]
    return _seed(spark, rows, "id, name, column_name, value_type_id, value_unit_id")
