"""Late readings: what a second partial average of a minute means.

Every micro-batch appends its mergeable partials (sum, count) per minute, sensor and
node to a log, in folders by day of its own that a replay rewrites.  The three policies are
three readings of that log, so no stored row is ever rewritten.

``seal`` folds the partials of whole days into one row per minute, sensor and node, which
keeps its parts by micro-batch.  A day's sealed folder says up to which micro-batch it goes;
readers take, for every day, the latest sealed folder and the open partials after it.  So
a seal that dies half way, or is repeated, changes nothing that is read, and the folders
of a log are bounded by its days and the micro-batches since the last seal.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugemill.functions import clock, numeric
from gaugemill.operators import readings
from gaugemill.session import folders, remove_folder

KEYS = ["observe_date", "sensor_name", "node_unique_id"]
PARTIALS = (
    "observe_date timestamp, sensor_name string, node_unique_id string, "
    "total decimal(28,6), n long, seen timestamp"
)


def partials(raw: DataFrame) -> DataFrame:
    """Sum and count per minute, sensor and node, and the latest reading's time.

    A group without a value counts 0; it shows that the minute was observed.
    """
    long = readings.all_readings(raw)
    return long.groupBy(
        clock.minute_of(F.col("observe_date")).alias("observe_date"),
        "sensor_name",
        "node_unique_id",
    ).agg(F.sum("sensor_value").alias("total"), F.count("sensor_value").alias("n"),
          F.max("observe_date").cast("timestamp").alias("seen"))


OPEN, SEALED, DAY = "open", "sealed", "obs_day"
PART = "struct<micro_batch:long,total:decimal(28,6),n:long,seen:timestamp>"
SEALED_ROWS = (
    "observe_date timestamp, sensor_name string, node_unique_id string, "
    f"parts array<{PART}>"
)


class PartialLog:
    """``foreachBatch`` step that appends a micro-batch's partials, by day."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, raw: DataFrame, batch_id: int) -> None:
        rows = partials(raw).withColumn(DAY, F.col("observe_date").cast("date"))
        (
            rows.hint("rebalance", DAY).write.mode("overwrite")
            .option("partitionOverwriteMode", "static").partitionBy(DAY)
            .parquet(f"{self.path}/{OPEN}/micro_batch={batch_id}")
        )


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _in_days(rows: DataFrame, since: date | None, before: date | None) -> DataFrame:
    """Rows of days from ``since`` on and up to before ``before``; prunes folders."""
    if since is not None:
        rows = rows.filter(F.col(DAY) >= F.lit(since))
    if before is not None:
        rows = rows.filter(F.col(DAY) < F.lit(before))
    return rows


def _open_and_sealed(
    spark: SparkSession, path: str, since: date | None, before: date | None
) -> tuple[DataFrame, DataFrame]:
    """Open partials that no sealed folder holds, and the latest sealed rows of every day."""
    sealed = _in_days(
        _stored(spark, f"{path}/{SEALED}", f"{SEALED_ROWS}, {DAY} date, upto long"), since, before
    )
    fresh = _in_days(
        _stored(spark, f"{path}/{OPEN}", f"{PARTIALS}, micro_batch long, {DAY} date"), since, before
    )
    # One row per calendar day.
    reach = F.broadcast(sealed.groupBy(F.col(DAY).alias("_day")).agg(F.max("upto").alias("_upto")))
    latest = sealed.join(reach, (F.col(DAY) == F.col("_day")) & (F.col("upto") == F.col("_upto")), "left_semi")
    after = fresh.join(
        reach, (F.col(DAY) == F.col("_day")) & (F.col("micro_batch") <= F.col("_upto")), "left_anti"
    )
    return after, latest


def read_log(
    spark: SparkSession, path: str, since: date | None = None, before: date | None = None
) -> DataFrame:
    """All partials (keys, total, n, seen, micro_batch), sealed or not, of a range of days."""
    after, latest = _open_and_sealed(spark, path, since, before)
    parts = latest.select(*KEYS, F.explode("parts").alias("p")).select(
        *KEYS, "p.total", "p.n", "p.seen", "p.micro_batch"
    )
    return after.select(*KEYS, "total", "n", "seen", "micro_batch").unionByName(parts)


def seal(spark: SparkSession, path: str, upto: int, before: date | None = None) -> None:
    """Fold the partials of micro-batches up to ``upto`` of days before ``before``.

    Only days with open partials are rewritten, each in a new folder.  What a new folder
    replaces is removed once all are written; partials that came for other days stay.
    """
    after, latest = _open_and_sealed(spark, path, None, before)
    mine = after.filter(F.col("micro_batch") <= upto)
    days = mine.select(DAY).distinct()
    part = F.struct("micro_batch", "total", "n", "seen")
    parts = (
        mine.select(*KEYS, DAY, part.alias("p"))
        .unionByName(
            latest.join(F.broadcast(days), DAY, "left_semi")
            .select(*KEYS, DAY, F.explode("parts").alias("p"))
        )
        # A part is one row of a key and a micro-batch: few per minute.
        .groupBy(*KEYS, DAY).agg(F.array_sort(F.collect_list("p")).alias("parts"))
    )
    (
        parts.withColumn("upto", F.lit(upto).cast("long"))
        .hint("rebalance", DAY).sortWithinPartitions(DAY, "observe_date")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, "upto").parquet(f"{path}/{SEALED}")
    )
    _remove_replaced(spark, path)


def _remove_replaced(spark: SparkSession, path: str) -> None:
    """Remove folders that readers pass over: older seals of a day, and open partials they hold."""
    reach = {}
    for day in folders(spark, f"{path}/{SEALED}"):
        for seal_folder in folders(spark, day):
            upto = int(seal_folder.rsplit("=", 1)[1])
            reach.setdefault(day.rsplit("=", 1)[1], []).append((upto, seal_folder))
    gone = [f for seals in reach.values() for _, f in sorted(seals)[:-1]]
    for batch in folders(spark, f"{path}/{OPEN}"):
        number = int(batch.rsplit("=", 1)[1])
        days = folders(spark, batch)
        held = [d for d in days if number <= max(reach.get(d.rsplit("=", 1)[1], [(-1, "")]))[0]]
        gone += [batch] if len(held) == len(days) else held
    for folder in gone:
        remove_folder(spark, folder)


def watermark(log: DataFrame) -> Column:
    """Time of the latest reading of all deliveries so far."""
    return log.agg(F.max("seen")).scalar()


def merged(log: DataFrame) -> DataFrame:
    """One partial per minute, sensor and node, whatever the order of deliveries."""
    return log.groupBy(*KEYS).agg(
        F.sum("total").cast("decimal(28,6)").alias("total"), F.sum("n").alias("n")
    )


def _valued(log: DataFrame) -> DataFrame:
    return log.filter("n > 0")


def _mean() -> Column:
    return F.round(numeric.mean_of(F.col("total"), F.col("n")), 2).alias("sensor_value")


def append_policy(log: DataFrame) -> DataFrame:
    """Each partial is a row of its own: a late reading adds a second average."""
    return _valued(log).select(*KEYS, "micro_batch", _mean())


def overwrite_policy(log: DataFrame) -> DataFrame:
    """The latest partial replaces earlier ones."""
    latest = F.max_by(F.struct("total", "n"), F.col("micro_batch")).alias("_last")
    return (
        _valued(log).groupBy(*KEYS).agg(latest)
        .select(*KEYS, F.col("_last.total").alias("total"), F.col("_last.n").alias("n"))
        .select(*KEYS, _mean())
    )


def exact_policy(log: DataFrame) -> DataFrame:
    """Partials are merged: the mean over all readings, late or not."""
    return merged(_valued(log)).select(*KEYS, _mean())
