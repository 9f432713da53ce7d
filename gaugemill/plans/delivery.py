"""The delivery loop: send pending averages, go by the replies, repeat.

A round sends what is due, newest first, and writes one row per row sent to an attempt log
beside the rollup before it acts on the replies.  A delivered row (201) is acknowledged, an
unknown address (404) is tried again after a pause, a refused credential (401) ends the run,
and anything else stays pending.  A run that dies is resumed by the next one: the log of the
last round says what is to be acknowledged, and its rounds are counted on.

Sending itself is a function of the caller's: (documents, round) to (id, status_code).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugemill.constants import FEED_LOOP_S, NOT_FOUND_PAUSE_S, PENDING_FEED_ROWS
from gaugemill.functions import clock
from gaugemill.operators import gates, outbox, rollup
from gaugemill.plans import jobs, ledger
from gaugemill.session import folders, materialize
from gaugemill.sources import observations as store
from gaugemill.streaming import runner

ATTEMPT = "id long, outcome string, sent_at timestamp, retry_at timestamp"

Send = Callable[[DataFrame, int], DataFrame]


def attempts_path(rollup_path: str) -> str:
    return f"{rollup_path}_jobs/attempts"


def read_attempts(spark: SparkSession, rollup_path: str) -> DataFrame:
    """(id, outcome, sent_at, retry_at, round) of every row ever sent."""
    found = ledger.stored(spark, attempts_path(rollup_path), ATTEMPT + ", round int")
    return spark.createDataFrame([], ATTEMPT + ", round int") if found is None else found


def attempt_counts(attempts: DataFrame) -> DataFrame:
    """(id, attempts, last_outcome) of every row that was sent."""
    return attempts.groupBy("id").agg(
        F.count(F.lit(1)).alias("attempts"), F.max_by("outcome", "round").alias("last_outcome")
    )


def due(pending: DataFrame, attempts: DataFrame, now: datetime) -> DataFrame:
    """Pending rows that do not wait for a retry."""
    waits = attempts.filter(F.col("retry_at") > clock.instant(now)).select("id").distinct()
    return pending.join(waits, "id", "left_anti")


def send_round(
    spark: SparkSession, rollup_path: str, models: DataFrame, send: Send, now: datetime,
    rows: int | None = PENDING_FEED_ROWS,
) -> dict[str, int]:
    """One round; how many rows had which outcome.  Empty where nothing was due."""
    number = resume(spark, rollup_path) + 1
    stored = store.read_rollup(spark, rollup_path)
    named = rollup.named_observations(gates.not_imported(stored), models)
    waiting = due(named, read_attempts(spark, rollup_path), now)
    sent = materialize(outbox.newest_pending(waiting, rows), "sending")
    if sent.isEmpty():
        return {}
    replies = materialize(send(outbox.payload_documents(sent), number), "replies")
    routed = outbox.route(sent, replies, stop_at_fatal=True, keep_unsent=False)
    at = clock.instant(now)
    log = routed.select(
        "id", "outcome", at.cast("timestamp").alias("sent_at"),
        F.when(F.col("outcome") == "retry", clock.instant(now + timedelta(seconds=NOT_FOUND_PAUSE_S)))
        .cast("timestamp").alias("retry_at"),
    )
    log.write.mode("overwrite").parquet(f"{attempts_path(rollup_path)}/round={number}")
    acknowledge_round(spark, rollup_path, number)
    found = _round(spark, rollup_path, number).groupBy("outcome").count().collect()
    return {r["outcome"]: r["count"] for r in found}


def _round(spark: SparkSession, rollup_path: str, number: int) -> DataFrame:
    return spark.read.schema(ATTEMPT).parquet(f"{attempts_path(rollup_path)}/round={number}")


def acknowledge_round(spark: SparkSession, rollup_path: str, number: int) -> None:
    jobs.acknowledge(spark, rollup_path, outbox.acked_ids(_round(spark, rollup_path, number)))


def resume(spark: SparkSession, rollup_path: str) -> int:
    """Number of the last round, whose acknowledgements are noted (again, if need be)."""
    rounds = [
        int(folder.rsplit("=", 1)[1])
        for folder in folders(spark, attempts_path(rollup_path)) if "round=" in folder
    ]
    # A round that died while writing its log holds no rows and is sent again.
    last = max(rounds, default=0)
    if last and _round(spark, rollup_path, last).isEmpty():
        return last - 1
    if last:
        done = store.read_rollup(spark, rollup_path).filter("imported").select("id")
        open_acks = outbox.acked_ids(_round(spark, rollup_path, last)).join(done, "id", "left_anti")
        if not open_acks.isEmpty():
            jobs.acknowledge(spark, rollup_path, open_acks)
    return last


def drain(
    spark: SparkSession, rollup_path: str, models: DataFrame, send: Send, now: datetime,
    rounds: int | None = None, rows: int | None = PENDING_FEED_ROWS,
) -> bool:
    """Rounds, FEED_LOOP_S apart, until nothing is due; False if a credential was refused.

    The clock is the caller's: a round's time is ``now`` plus the pauses before it.
    """
    done = 0
    while rounds is None or done < rounds:
        outcomes = send_round(
            spark, rollup_path, models, send, now + timedelta(seconds=done * FEED_LOOP_S), rows
        )
        if "fatal" in outcomes:
            return False
        if not outcomes:
            return True
        done += 1
    return True


def on_cadence(
    spark: SparkSession, rollup_path: str, models: DataFrame, send: Send, checkpoint: str,
    now: Callable[[], datetime],
) -> StreamingQuery:
    """One round every FEED_LOOP_S; a refused credential stops the query with an error."""

    def step(_: DataFrame, __: int) -> None:
        if "fatal" in send_round(spark, rollup_path, models, send, now()):
            raise PermissionError("the receiver refused the credentials")

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = runner.per_batch(ticks, step, checkpoint)
    return writer.trigger(processingTime=f"{FEED_LOOP_S} seconds").start()
