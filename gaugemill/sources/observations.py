"""Stored observation tables: day-partitioned scans and appends."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gaugemill import schemas
from gaugemill.functions import clock
from gaugemill.session import remove_folder

DAY = "obs_day"
LOAD = "load_at"
LOAD_KEYS = [DAY, LOAD]
ORDER = ["observe_date"]


def with_day(df: DataFrame, ts: str = "observe_date") -> DataFrame:
    return df.withColumn(DAY, F.col(ts).cast("date"))


def stored_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAY, T.DateType(), True)])


def scan_raw(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    since: datetime | None = None,
    before: datetime | None = None,
) -> DataFrame:
    """Raw observations; the time range prunes day folders and row groups."""
    df = spark.read.schema(stored_schema(schemas.OBSERVATION_RAW)).parquet(path)
    ts_type = df.schema["observe_date"].dataType
    if since is not None:
        df = df.filter(
            (F.col(DAY) >= F.lit(clock.naive_utc(since).date()))
            & (F.col("observe_date") >= clock.instant(since, ts_type))
        )
    if before is not None:
        df = df.filter(
            (F.col(DAY) <= F.lit(clock.naive_utc(before).date()))
            & (F.col("observe_date") < clock.instant(before, ts_type))
        )
    return df.select(*columns) if columns else df


def _by_folder(df: DataFrame, *folders: str) -> DataFrame:
    """Rows clustered by target folder, in evenly sized tasks.

    A task then opens few files, and a folder that receives most of the rows is
    split over several tasks by adaptive execution.  Rows are sorted by time within a
    task, so the statistics of row groups prune within a day.
    """
    return df.hint("rebalance", *folders).sortWithinPartitions(*folders, *ORDER)


def append_by_day(df: DataFrame, path: str, ts: str = "observe_date") -> None:
    """Append rows below their day folder."""
    _by_folder(with_day(df, ts), DAY).write.mode("append").partitionBy(DAY).parquet(path)


def append_raw(observations: DataFrame, path: str) -> None:
    """Append new raw observations, not yet imported."""
    append_by_day(
        observations.select(
            F.col("id").cast("long"),
            F.col("observe_date").cast("timestamp"),
            "sensor_values",
            F.lit(False).alias("imported"),
        ),
        path,
    )


def rollup_rows(rows: DataFrame) -> DataFrame:
    """New minute averages in the stored form, not yet delivered."""
    return rows.select(
        F.col("id").cast("long"),
        F.col("observe_date").cast("timestamp"),
        F.col("node_model_id").cast("int"),
        F.col("sensor_value").cast("decimal(12,6)"),
        "node_unique_id",
        F.lit(False).alias("imported"),
    )


def load_label(as_of: datetime) -> str:
    return clock.naive_utc(as_of).strftime("%Y%m%dT%H%M%S")


def write_load(rows: DataFrame, path: str, as_of: datetime) -> None:
    """Append one load of minute averages in folders of its own.

    Repeating a load replaces its folders, so nothing is stored twice.
    """
    overwrite_loads(with_day(rollup_rows(rows)).withColumn(LOAD, F.lit(load_label(as_of))), path)


def overwrite_loads(rows: DataFrame, path: str) -> None:
    """Replace exactly the (day, load) folders that occur in ``rows``."""
    (
        _by_folder(rows, *LOAD_KEYS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LOAD_KEYS)
        .parquet(path)
    )


ACKS = "id long"


def acks_path(rollup_path: str) -> str:
    return f"{rollup_path}_jobs/acks"


def append_acks(acked: DataFrame, rollup_path: str) -> None:
    """Ids of delivered averages, as one more small file beside the rollup."""
    ids = acked.select(F.col("id").cast("long").alias("id")).distinct()
    ids.write.parquet(f"{acks_path(rollup_path)}/{uuid.uuid4().hex}")


def read_rollup(spark: SparkSession, path: str, with_acks: bool = True) -> DataFrame:
    """Stored averages, flagged as delivered where the rollup or a later note says so."""
    schema = stored_schema(schemas.OBSERVATION)
    rows = spark.read.schema(schema.add(LOAD, T.StringType())).parquet(path)
    try:
        notes = spark.read.schema(ACKS).parquet(f"{acks_path(path)}/*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return rows
    if not with_acks:
        return rows
    noted = notes.distinct().select("id", F.lit(True).alias("_noted"))
    flag = F.col("imported") | F.coalesce(F.col("_noted"), F.lit(False))
    return rows.join(noted, "id", "left").withColumn("imported", flag).select(*rows.columns)


def overwrite_days(df: DataFrame, path: str, ts: str = "observe_date") -> None:
    """Replace exactly the day folders that occur in ``df``; other days stay.

    ``df`` must not read from ``path`` any more (see ``session.materialize``).
    """
    (
        _by_folder(with_day(df, ts), DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def drop_days(spark: SparkSession, path: str, days: list[date]) -> None:
    """Remove whole day folders; a folder that is gone already is no error."""
    for day in days:
        remove_folder(spark, f"{path}/{DAY}={day.isoformat()}")
