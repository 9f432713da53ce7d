"""Sensor tables derived from the generic ``events`` table.

Spark derives every table from all events, so each registered query grows with
the given data.  Elapsed time is divided by 60 to bring many readings into a minute.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugemill.constants import PROBE_ARRAY_KEY, PROBE_KEY
from gaugemill.functions import calendar, clock
from gaugemill.operators import readings

BASE_US = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC
CLOCK_DIVISOR = 60
AS_OF = datetime(2024, 1, 1, 6, 0, 30)
ZONES = ("UTC", "America/Denver", "Europe/Berlin")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_time(ts: Column) -> Column:
    micros = F.unix_micros(ts.cast("timestamp"))
    shifted = F.call_function("div", micros - F.lit(BASE_US), F.lit(CLOCK_DIVISOR))
    return F.timestamp_micros(F.lit(BASE_US) + shifted)


def amount_text() -> Column:
    return F.col("value").cast("decimal(12,2)").cast("string")


def lines_from(events: DataFrame) -> DataFrame:
    """Station line stream, with blank, malformed and sentinel lines among the errors."""
    amount = amount_text()
    kind = F.col("event_type")
    broken = (
        F.when(F.col("event_id") % 4 == 0, "")
        .when(F.col("event_id") % 4 == 1, "Address 3")
        .when(F.col("event_id") % 4 == 2, "dht11_t:bad")
        .otherwise("dht11_t:-127.00:extra")
    )
    line = (
        F.when(kind == "signup", F.concat(F.lit("dht11_t:"), amount))
        .when(kind == "purchase", F.concat(F.lit("dht11_h:"), amount))
        .when(kind == "view", F.concat(F.lit("ds18b20_t:"), amount))
        .when(
            kind == "click",
            F.concat(F.lit("ds18b20_t_N"), F.col("user_id") % 5, F.lit(":"), amount),
        )
        .otherwise(broken)
    )
    return events.select(
        F.concat(F.lit("st"), F.col("user_id") % 5).alias("station"),
        F.col("event_id").alias("line_no"),
        event_time(F.col("ts")).alias("arrived_at"),
        line.alias("line"),
    )


def document() -> Column:
    amount = amount_text()
    kind = F.col("event_type")
    node = F.concat(F.lit('{"N'), F.col("user_id") % 5, F.lit('": '), amount, F.lit("}"))
    return (
        F.when(kind == "signup", F.concat(F.lit('{"dht11_t": '), amount, F.lit("}")))
        .when(kind == "purchase", F.concat(F.lit('{"dht11_h": '), amount, F.lit("}")))
        .when(kind == "view", F.concat(F.lit('{"ds18b20_t": '), amount, F.lit("}")))
        .when(
            kind == "click",
            F.concat(F.lit('{"ds18b20_t_uq": ['), node, F.lit(","), node, F.lit(',{"X": -127}]}')),
        )
        .otherwise('{"ds18b20_t": -127}')
    )


def raw_from(events: DataFrame) -> DataFrame:
    """Raw observations, one per event."""
    return events.select(
        F.col("event_id").alias("id"),
        event_time(F.col("ts")).alias("observe_date"),
        document().alias("sensor_values"),
        (F.col("event_id") % 7 == 0).alias("imported"),
    )


def spoiled_from(events: DataFrame) -> DataFrame:
    """Raw observations whose node arrays also hold values that are no readings.

    Documents with one probe get a member that is no array at all.
    """
    opening = f'"{PROBE_ARRAY_KEY}": ['
    spoiled = opening + '{"B": "bad"},{"H": 1e15},{"O": {"q": 1}},'
    whole = F.concat(
        F.expr("substring(sensor_values, 1, length(sensor_values) - 1)"),
        F.lit(f', "{PROBE_ARRAY_KEY}": {{"N9": 3}}}}'),
    )
    return raw_from(events).withColumn(
        "sensor_values",
        F.when(F.col("sensor_values").contains(opening),
               F.replace("sensor_values", F.lit(opening), F.lit(spoiled)))
        .when(F.col("sensor_values").startswith(f'{{"{PROBE_KEY}"'), whole)
        .otherwise(F.col("sensor_values")),
    )


def keyed_raw_from(events: DataFrame) -> DataFrame:
    """Raw observations under date and second keys, with every signup replayed.

    A replay repeats reading and second under another id (the negative one).
    """
    when = event_time(F.col("ts"))
    zone = (
        F.when(F.col("user_id") % 3 == 0, ZONES[0])
        .when(F.col("user_id") % 3 == 1, ZONES[1])
        .otherwise(ZONES[2])
    )
    ids = F.when(
        F.col("event_type") == "signup", F.array(F.col("event_id"), -F.col("event_id") - 1)
    ).otherwise(F.array(F.col("event_id")))
    keys = events.select(
        ids.alias("_ids"),
        calendar.calendar_id_of(when.cast("date")).alias("calendar_id"),
        clock.time_id_of(clock.second_of_day(when)).alias("time_id"),
        zone.alias("timezone"),
        document().alias("sensor_values"),
        (F.col("event_id") % 7 == 0).alias("imported"),
    )
    return keys.select(
        F.explode("_ids").alias("observation_id"),
        *[c for c in keys.columns if c != "_ids"],
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(table(spark, sf_dir, "events"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from(table(spark, sf_dir, "events"))


def keyed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_raw_from(table(spark, sf_dir, "events"))


def delivery_results_for(rollup: DataFrame) -> DataFrame:
    """Replies of the delivery service, by last digit of the row id."""
    digit = F.col("id") % 10
    return rollup.select(
        "id",
        F.when(digit <= 6, 201).when(digit == 7, 404).when(digit == 8, 500)
        .otherwise(401).alias("status_code"),
    )


DELIVERED_UNTIL = datetime(2024, 1, 1, 3, 0)
HUMIDITY_DELIVERED_UNTIL = datetime(2024, 1, 1, 6, 0)


def receipts_for(raw_rows: DataFrame) -> DataFrame:
    """Receipts of the older quarter-hours; the temperature sensor writes '' for no node."""
    quarter_us = 900 * 1_000_000
    quarter = F.call_function("div", F.unix_micros("observe_date"), F.lit(quarter_us))
    end = F.timestamp_micros(F.col("_quarter") * quarter_us + 14 * 60 * 1_000_000)
    sensor, node = F.col("sensor_name"), F.col("node_unique_id")
    windows = (
        readings.all_readings(raw_rows)
        .filter(F.col("sensor_value").isNotNull())
        .select(quarter.alias("_quarter"), "sensor_name", "node_unique_id")
        .distinct()
        .select(end.alias("end_15min"), "sensor_name", "node_unique_id")
    )
    delivered = (F.col("end_15min") < clock.instant(DELIVERED_UNTIL)) | (
        (sensor == "dht11_h") & (F.col("end_15min") < clock.instant(HUMIDITY_DELIVERED_UNTIL))
    )
    return windows.filter(delivered).withColumn(
        "node_unique_id", F.when(node.isNull() & (sensor == "dht11_t"), "").otherwise(node)
    )


def replies_of_round(documents: DataFrame, number: int) -> DataFrame:
    """Replies to sent documents (id, ...) that change from round to round.

    By the last digit of the id: 0 to 2 and 9 are taken at once, 3 and 4 at the second try
    after 404, 5 after 500 and 404; 6 gets 500 for ever, 7 no reply; 8 gets 500 twice, then
    401 where the last two digits are 08 and else 201.
    """
    digit = F.col("id") % 10
    at_last = F.when(F.col("id") % 100 == 8, 401).otherwise(201)
    by_round = {
        1: F.when(digit.isin(0, 1, 2, 9), 201).when(digit.isin(3, 4), 404).when(digit != 7, 500),
        2: F.when(digit.isin(3, 4), 201).when(digit == 5, 404).when(digit != 7, 500),
    }
    third = F.when(digit == 5, 201).when(digit == 8, at_last).when(digit != 7, 500)
    return documents.select("id", by_round.get(number, third).cast("int").alias("status_code")).filter(
        "status_code is not null"
    )
