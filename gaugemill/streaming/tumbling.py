"""Event-time tumbling averages of closed windows only.

A window closes when the watermark passes its end; the delay plays the part of the
guard time.  Two forms:

* ``minute_averages`` and ``quarter_averages`` are streaming aggregations with bounded
  state, for one delivery in order of time: rows behind the watermark are dropped.
* ``closed_minutes`` and ``closed_quarters`` read the log of partials that a stream of
  deliveries in any order appends to (``late.PartialLog``).  A late row corrects its
  window; nothing is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugemill.functions import clock, numeric
from gaugemill.operators import readings, rollup
from gaugemill.streaming import late

NO_DELAY = "0 seconds"
GUARD_DELAY = "2 minutes"


def _minute_means(raw: DataFrame, delay: str) -> DataFrame:
    long = readings.all_readings(raw.withWatermark("observe_date", delay))
    return long.groupBy(
        F.window("observe_date", "1 minute"), "sensor_name", "node_unique_id"
    ).agg(numeric.mean(F.col("sensor_value")).alias("sensor_value"))


def minute_averages(raw: DataFrame, models: DataFrame, delay: str = NO_DELAY) -> DataFrame:
    """One-minute means per sensor and node; de-duplication stays inside each row."""
    means = _minute_means(raw, delay).select(
        F.col("window.start").alias("observe_date"), "sensor_name", "node_unique_id", "sensor_value"
    )
    return rollup.attach_model(means, models).select(
        "observe_date", "node_model_id", "sensor_name", "node_unique_id", "sensor_value"
    )


def quarter_averages(raw: DataFrame, delay: str = GUARD_DELAY) -> DataFrame:
    """Fifteen-minute means of the two-decimal minute means, labelled by the last minute."""
    minutes = _minute_means(raw, delay).withColumn(
        "sensor_value", F.round("sensor_value", 2).cast("decimal(18,6)")
    )
    quarters = minutes.groupBy(
        F.window(F.col("window"), "15 minutes"), "sensor_name", "node_unique_id"
    ).agg(numeric.rounded_mean(F.col("sensor_value"), 2).alias("sensor_value"))
    return quarters.select(
        F.col("window.start").alias("start_15min"),
        clock.plus_minutes(F.col("window.end"), -1).alias("end_15min"),
        "sensor_name",
        "node_unique_id",
        "sensor_value",
    )


def closed_minutes(log: DataFrame, models: DataFrame, delay_minutes: int = 0) -> DataFrame:
    """Means of all minutes that have ended, over every reading delivered for them."""
    ended = clock.plus_minutes(F.col("observe_date"), 1 + delay_minutes) <= late.watermark(log)
    means = late.merged(log).filter(ended).select(
        *late.KEYS, numeric.mean_of(F.col("total"), F.col("n")).alias("sensor_value")
    )
    return rollup.attach_model(means, models).select(
        "observe_date", "node_model_id", "sensor_name", "node_unique_id", "sensor_value"
    )


def closed_quarters(log: DataFrame, delay_minutes: int = 2) -> DataFrame:
    """Fifteen-minute means of the two-decimal minute means, labelled by the last minute."""
    minute = F.round(numeric.mean_of(F.col("total"), F.col("n")), 2).cast("decimal(18,6)")
    quarters = (
        late.merged(log)
        .groupBy(F.window("observe_date", "15 minutes"), "sensor_name", "node_unique_id")
        .agg(numeric.rounded_mean(minute, 2).alias("sensor_value"))
        .filter(clock.plus_minutes(F.col("window.end"), delay_minutes) <= late.watermark(log))
    )
    return quarters.select(
        F.col("window.start").alias("start_15min"),
        clock.plus_minutes(F.col("window.end"), -1).alias("end_15min"),
        "sensor_name",
        "node_unique_id",
        "sensor_value",
    )
