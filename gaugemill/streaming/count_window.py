"""Count windows over a line stream, for stations of any size.

Each micro-batch is numbered with the distributed block numbering, so a station that
sends most of the lines is not handled by a single task.  What must outlive a
micro-batch is small: fewer than N waiting lines per station and the next batch
number.  It is kept as one table version per micro-batch in the shared folder; a
replayed micro-batch reads the version before it and rewrites its own, so the result
is the same after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugemill.operators import batching, parsing
from gaugemill.operators.numbering import number_rows
from gaugemill.session import materialize
from gaugemill.sources.lines import position_levels, with_part_row

OBSERVATIONS = "station string, batch_no long, observe_date timestamp, sensor_values string"
COUNTERS = "station string, next_batch long"
WAITING = "station string, line_no long, arrived_at timestamp, line string, seq long"


class CountWindow:
    """``foreachBatch`` step that turns lines into observations."""

    def __init__(self, spark: SparkSession, size: int, out: str, state: str):
        self.spark = spark
        self.size = size
        self.out = out
        self.state = state

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        waiting, counters = self._state_before(batch_id)
        fresh = parsing.drop_blank(lines)
        from_files = "file_order" in fresh.columns
        if from_files:
            fresh = with_part_row(fresh)
        # Waiting lines arrived earlier, in the order of their sequence, whatever their
        # numbers: those start anew in every file and delivery.
        both = waiting.withColumn("phase", F.lit(0)).unionByName(
            fresh.withColumn("phase", F.lit(1)), allowMissingColumns=True
        )
        placed = position_levels() if from_files else {}
        numbered = materialize(
            number_rows(
                both, ["station"],
                {"_phase": F.col("phase"), "_seq": F.coalesce("seq", F.lit(0)), **placed,
                 **batching.line_levels()},
                ["line_no"], out="row_no", total="station_lines",
            ),
            "numbered",
        )
        # Order inside a batch follows the numbering.
        full, rest = batching.split_windows(
            numbered.withColumn("seq", F.col("row_no")), self.size
        )
        observations = batching.assemble(
            full.select("station", F.col("seq").alias("line_no"), "arrived_at", "line", "batch_no")
        )
        shifted = observations.join(counters, "station", "left").select(
            "station",
            (F.col("batch_no") + F.coalesce("next_batch", F.lit(0))).alias("batch_no"),
            "observe_date",
            "sensor_values",
        )
        shifted.write.mode("overwrite").parquet(f"{self.out}/micro_batch={batch_id}")
        self._write_state(batch_id, rest, numbered, counters)

    def observations(self, batch_id: int) -> DataFrame:
        """What one micro-batch gave."""
        return self.spark.read.schema(OBSERVATIONS).parquet(f"{self.out}/micro_batch={batch_id}")

    def _state_before(self, batch_id: int) -> tuple[DataFrame, DataFrame]:
        if batch_id == 0:
            return (
                self.spark.createDataFrame([], WAITING),
                self.spark.createDataFrame([], COUNTERS),
            )
        version = f"{self.state}/version={batch_id - 1}"
        return (
            self.spark.read.schema(WAITING).parquet(f"{version}/waiting"),
            self.spark.read.schema(COUNTERS).parquet(f"{version}/counters"),
        )

    def _write_state(
        self, batch_id: int, rest: DataFrame, numbered: DataFrame, counters: DataFrame
    ) -> None:
        version = f"{self.state}/version={batch_id}"
        rest.select("station", "line_no", "arrived_at", "line", F.col("seq").cast("long")).write.mode(
            "overwrite"
        ).parquet(f"{version}/waiting")
        done = numbered.groupBy("station").agg(
            F.call_function("div", F.max("station_lines"), F.lit(self.size)).alias("next_batch")
        )
        (
            counters.unionByName(done)
            .groupBy("station")
            .agg(F.sum("next_batch").alias("next_batch"))
            .write.mode("overwrite")
            .parquet(f"{version}/counters")
        )


def read_observations(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(OBSERVATIONS + ", micro_batch long").parquet(out).drop("micro_batch")
