"""Start streaming queries on the service's cadence, or drain what is available."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gaugemill.constants import ROLLUP_TRIGGER


def every_minute(writer: DataStreamWriter) -> StreamingQuery:
    return writer.trigger(processingTime=ROLLUP_TRIGGER).start()


def drain(writer: DataStreamWriter) -> None:
    """Process everything available now and stop; failures are raised."""
    writer.trigger(availableNow=True).start().awaitTermination()


def to_files(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append finished rows to a Parquet sink with exactly-once file commits."""
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def per_batch(
    stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def read_sink(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)
