"""Explicit schemas of every stored relation; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

LINES = T.StructType([
    T.StructField("station", T.StringType(), False),
    T.StructField("line_no", T.LongType(), False),
    T.StructField("arrived_at", T.TimestampType(), True),
    T.StructField("line", T.StringType(), True),
])

OBSERVATION_RAW = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("observe_date", T.TimestampType(), False),
    T.StructField("sensor_values", T.StringType(), False),
    T.StructField("imported", T.BooleanType(), False),
])

OBSERVATION = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("observe_date", T.TimestampType(), False),
    T.StructField("node_model_id", T.IntegerType(), False),
    T.StructField("sensor_value", T.DecimalType(12, 6), False),
    T.StructField("node_unique_id", T.StringType(), True),
    T.StructField("imported", T.BooleanType(), False),
])

VALUE_TYPE = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
])

VALUE_UNIT = VALUE_TYPE

NODE_MODEL = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("value_type_id", T.IntegerType(), False),
    T.StructField("value_unit_id", T.IntegerType(), False),
])

OBSERVATION_V1 = T.StructType([
    T.StructField("observation_id", T.LongType(), False),
    T.StructField("calendar_id", T.IntegerType(), False),
    T.StructField("time_id", T.IntegerType(), False),
    T.StructField("timezone", T.StringType(), False),
    T.StructField("sensor_values", T.StringType(), False),
    T.StructField("imported", T.BooleanType(), False),
])

OBSERVATION_MINUTE = T.StructType([
    T.StructField("calendar_id", T.IntegerType(), False),
    T.StructField("time_id", T.IntegerType(), False),
    T.StructField("timezone", T.StringType(), False),
    T.StructField("sensor_name", T.StringType(), True),
    T.StructField("node_unique_id", T.StringType(), True),
    T.StructField("sensor_value", T.DecimalType(12, 6), True),
])

RECEIPTS = T.StructType([
    T.StructField("end_15min", T.TimestampType(), False),
    T.StructField("sensor_name", T.StringType(), False),
    T.StructField("node_unique_id", T.StringType(), True),
])

DELIVERY_RESULTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("status_code", T.IntegerType(), True),
])
