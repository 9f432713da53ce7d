"""Stored minute facts: upserts that rewrite only the files a delta touches.

The fact lies in folders by date key and by a bucket of the reading's key, so a delta of
few minutes or few sensors reads and replaces few folders; all others keep their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugemill.functions import text
from gaugemill.operators import state
from gaugemill.operators.keyed import MINUTE_KEY
from gaugemill.schemas import OBSERVATION_MINUTE
from gaugemill.session import discard, folders, materialize

DAY, BUCKET = "day_key", "bucket"
BUCKETS = 16


def _placed(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows with their folder; NULL and empty key parts of one sensor share a bucket."""
    key = F.xxhash64("sensor_name", text.or_empty(F.col("node_unique_id")))
    return rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in OBSERVATION_MINUTE.fields],
        F.col("calendar_id").cast("int").alias(DAY),
        F.pmod(key, F.lit(buckets)).cast("int").alias(BUCKET),
    )


def _replace(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", DAY, BUCKET).sortWithinPartitions(DAY, BUCKET, "time_id")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, BUCKET).parquet(path)
    )


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path).select(*OBSERVATION_MINUTE.fieldNames())


def _stored(spark: SparkSession, path: str) -> DataFrame:
    ddl = f"{OBSERVATION_MINUTE.toDDL()}, {DAY} int, {BUCKET} int"
    return spark.read.schema(ddl).parquet(path)


def upsert_fact(
    delta: DataFrame, path: str, null_safe: bool = False, buckets: int = BUCKETS
) -> None:
    """Merge ``delta`` into the stored fact: new rows replace old ones of equal key.

    Only folders that the delta's rows fall into are read and rewritten.
    """
    spark = delta.sparkSession
    new = materialize(_placed(delta, buckets), "delta")
    if folders(spark, path):
        touched = new.select(DAY, BUCKET).distinct()  # at most days x buckets rows
        old = _stored(spark, path).join(F.broadcast(touched), [DAY, BUCKET], "left_semi")
        old = old.select(*OBSERVATION_MINUTE.fieldNames())
        merged = state.upsert(old, new.select(*old.columns), MINUTE_KEY, null_safe)
        whole = materialize(_placed(merged, buckets), "merged")
        _replace(whole, path)
        discard(whole)
    else:
        _replace(new, path)
    discard(new)
