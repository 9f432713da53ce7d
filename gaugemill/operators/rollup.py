"""Minute averages of raw observations (timestamped form)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugemill.functions import clock, numeric
from gaugemill.operators import readings

MINUTE_COLUMNS = [
    "observe_date", "node_model_id", "sensor_name", "node_unique_id", "imported", "sensor_value",
]


def attach_model(named: DataFrame, models: DataFrame) -> DataFrame:
    """Catalogue row of each named reading; readings of unknown sensors are dropped.

    The catalogue is joined without a hint: its size is in the statistics, from
    which the planner decides whether to broadcast it.
    """
    catalogue = models.select(
        F.col("id").alias("node_model_id"), F.col("column_name").alias("sensor_name")
    )
    return named.join(catalogue, "sensor_name")


def average_by_minute(named: DataFrame, models: DataFrame) -> DataFrame:
    """Mean per minute, sensor, node and imported flag.

    Partial aggregation reduces a hot minute in every task before the one shuffle;
    the catalogue is joined to the few averages instead of to all readings, which is
    the same because the model id is a function of the group key.
    """
    means = named.groupBy(
        clock.minute_of(F.col("observe_date")).cast(named.schema["observe_date"].dataType)
        .alias("observe_date"),
        "sensor_name",
        "node_unique_id",
        "imported",
    ).agg(numeric.mean(F.col("sensor_value")).alias("sensor_value"))
    return attach_model(means, models).select(*MINUTE_COLUMNS)


def minute_avg_nodes(raw: DataFrame, models: DataFrame) -> DataFrame:
    """Probe sensor: scalar and per-node readings, known-bad values left out."""
    return average_by_minute(readings.probe_readings(raw, named=True), models)


def minute_avg_scalar(raw: DataFrame, models: DataFrame) -> DataFrame:
    """Scalar sensors; a minute without any value keeps a NULL average."""
    named = readings.scalar_readings(raw).withColumn(
        "node_unique_id", F.lit(None).cast("string")
    )
    return average_by_minute(named, models)


def minute_averages(raw: DataFrame, models: DataFrame) -> DataFrame:
    """Both of the above from one scan and one aggregation (their sensors are disjoint)."""
    return average_by_minute(readings.all_readings(raw), models)


def named_observations(rollup: DataFrame, models: DataFrame) -> DataFrame:
    """Stored averages with the sensor name instead of the model id."""
    names = models.select(
        F.col("id").alias("node_model_id"), F.col("column_name").alias("sensor_name")
    )
    return rollup.join(names, "node_model_id").select(
        "id", "observe_date", "sensor_name", "sensor_value", "node_unique_id", "imported"
    )
