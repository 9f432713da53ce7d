"""Delivery feeds as JSON documents, and routing of delivery results."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.constants import (
    NOT_FOUND_PAUSE_S, PENDING_FEED_ROWS, QUARTER_FEED_ROWS, STATUS_CREATED,
    STATUS_NOT_FOUND, STATUS_UNAUTHORIZED,
)
from gaugemill.functions import json_docs
from gaugemill.operators import gates

FEED_COLUMNS = ("id", "observe_date", "sensor_name", "node_unique_id", "sensor_value")


def newest_pending(named: DataFrame, rows: int | None = PENDING_FEED_ROWS) -> DataFrame:
    """Newest undelivered averages; ties are broken by id.  ``rows=None`` takes all."""
    pending = gates.not_imported(named)
    if rows is None:
        return pending
    return pending.orderBy(F.col("observe_date").desc(), F.col("id")).limit(rows)


def payload_rows(pending: DataFrame) -> DataFrame:
    """Fields of a delivery document, value rounded to two decimals."""
    return pending.select(
        "id",
        F.col("observe_date").cast("timestamp").alias("observe_date"),
        "sensor_name",
        "node_unique_id",
        F.round("sensor_value", 2).alias("sensor_value"),
    )


def pending_feed(named: DataFrame, rows: int | None = PENDING_FEED_ROWS) -> DataFrame:
    """One JSON document per pending average."""
    fields = payload_rows(newest_pending(named, rows))
    return fields.select(json_docs.row_json(*FEED_COLUMNS).alias("observation_data"))


def payload_documents(pending: DataFrame) -> DataFrame:
    """(id, observation_data): each pending average with its JSON document."""
    return payload_rows(pending).select(
        "id", json_docs.row_json(*FEED_COLUMNS).alias("observation_data")
    )


def enriched_feed(named: DataFrame, api_key: str, sensor_id: str) -> DataFrame:
    """All pending averages with the sender's credentials added to every document."""
    fields = payload_rows(newest_pending(named, None))
    return fields.select(
        "id",
        json_docs.row_json(
            *FEED_COLUMNS, F.lit(api_key).alias("api_key"), F.lit(sensor_id).alias("sensor_id")
        ).alias("observation_data"),
    )


def oldest_unsent(
    windows: DataFrame, as_of: datetime, rows: int | None = QUARTER_FEED_ROWS
) -> DataFrame:
    """Oldest elapsed quarter-hours without receipt; further columns break ties."""
    unsent = gates.elapsed(windows, as_of, grace_minutes=1).filter(F.col("submitted_to_api") == 0)
    if rows is None:
        return unsent
    ties = [c for c in ("sensor_name", "node_unique_id", "timezone") if c in windows.columns]
    return unsent.orderBy("datum", "quarterhour", *ties).limit(rows)


def quarter_feed(
    windows: DataFrame, as_of: datetime, rows: int | None = QUARTER_FEED_ROWS
) -> DataFrame:
    """One JSON document per unsent quarter-hour."""
    return oldest_unsent(windows, as_of, rows).select(
        json_docs.row_json(*windows.columns).alias("observation_data")
    )


def first_quarter_feed(
    windows: DataFrame, as_of: datetime, rows: int = QUARTER_FEED_ROWS
) -> DataFrame:
    """The feed before receipts existed: oldest elapsed quarter-hours, sent or not."""
    elapsed = gates.elapsed(windows, as_of).orderBy("datum", "quarterhour", "timezone").limit(rows)
    return elapsed.select(json_docs.row_json(*windows.columns).alias("observation_data"))


def backlog(rows: DataFrame) -> DataFrame:
    """Number of undelivered rows."""
    return gates.not_imported(rows).agg(F.count(F.lit(1)).alias("pending"))


def outcome(status: Column) -> Column:
    return (
        F.when(status == STATUS_CREATED, "acked")
        .when(status == STATUS_UNAUTHORIZED, "fatal")
        .when(status == STATUS_NOT_FOUND, "retry")
        .otherwise("pending")
    )


def route(
    pending: DataFrame, results: DataFrame, stop_at_fatal: bool = False, keep_unsent: bool = True
) -> DataFrame:
    """What becomes of each pending row: acked, fatal, retry or pending.

    Rows are sent newest first.  With ``stop_at_fatal`` the first refused credential
    ends the run, and every row behind it stays pending, or is left out unless
    ``keep_unsent``.
    """
    replies = results.select("id", "status_code")
    joined = pending.join(replies, "id", "left")
    routed = joined.select(
        "id",
        "observe_date",
        outcome(F.col("status_code")).alias("outcome"),
    )
    if stop_at_fatal:
        newest = F.struct("observe_date", (-F.col("id")).alias("back"))
        stop = routed.filter(F.col("outcome") == "fatal").agg(F.max(newest)).scalar()
        behind = F.coalesce(newest < stop, F.lit(False))
        if not keep_unsent:
            routed = routed.filter(~behind)
        routed = routed.withColumn(
            "outcome", F.when(behind, "pending").otherwise(F.col("outcome"))
        )
    pause = F.when(F.col("outcome") == "retry", NOT_FOUND_PAUSE_S).otherwise(0.0)
    return routed.select("id", "outcome", pause.alias("retry_after_s"))


def acked_ids(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("outcome") == "acked").select("id")
