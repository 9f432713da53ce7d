"""State changes as pure functions: (state, change) -> new state.

Plain Parquet has no UPDATE or DELETE.  A job rewrites only the day folders that a
change touches (``touched_days``) with the result of these functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.constants import RETENTION_HOURS, STORED_TYPE
from gaugemill.functions import calendar, clock, text
from gaugemill.operators import gates, keyed as keyed_ops, rollup
from gaugemill.operators.numbering import block_offsets, number_rows

RECEIPT_KEYS = ("end_15min", "sensor_name", "node_unique_id")


# ---- surrogate ids --------------------------------------------------------------

def _spread(name: Column) -> Column:
    """First digits of a hash: splits any set of names into up to 4096 parts."""
    return F.substring(F.md5(name), 1, 3)


def observation_ids(observations: DataFrame, start: int = 0) -> DataFrame:
    """Dense ids ``start + 1 …`` for new observations.

    Batch numbers are already dense within a station, so an id is the station's
    start offset plus the batch number; only per-station counts are aggregated.
    A 64-bit hash would be shorter but collides beyond some 10^9 rows.
    """
    counts = (
        observations.groupBy("station")
        .agg(F.count(F.lit(1)).alias("n"), F.min("batch_no").alias("_first"))
        .withColumn("_part", _spread(F.col("station")))
    )
    offsets = block_offsets(counts, [], ["_part", "station"], offset="_offset")
    starts = offsets.join(counts.select("station", "_first"), "station").select(
        "station", "_offset", "_first"
    )
    numbered = observations.join(starts, "station")
    number = F.col("_offset") + F.col("batch_no") - F.col("_first") + F.lit(start + 1)
    return numbered.select(number.alias("id"), *observations.columns)


def rollup_ids(rows: DataFrame, start: int = 0) -> DataFrame:
    """Dense ids for new minute averages, in order of minute, node part, model, node."""
    node = text.or_empty(F.col("node_unique_id"))
    levels = {
        "_day": F.col("observe_date").cast("date"),
        "_minute": F.col("observe_date"),
        "_part": F.substring(F.md5(node), 1, 2),
    }
    order = ["node_model_id", node, F.col("node_unique_id").isNotNull()]
    numbered = number_rows(rows, [], levels, order, out="_n")
    return numbered.select((F.col("_n") + F.lit(start)).alias("id"), *rows.columns)


# ---- imported flags -------------------------------------------------------------

def mark_imported(raw: DataFrame, minutes: DataFrame) -> DataFrame:
    """Flag raw rows whose minute is among the loaded minutes."""
    ts_type = raw.schema["observe_date"].dataType
    keys = minutes.select(
        F.col("observe_date").cast(ts_type).alias("_minute"), F.lit(True).alias("_loaded")
    ).distinct()
    minute = clock.minute_of(F.col("observe_date")).cast(ts_type)
    return _flag(raw.withColumn("_minute", minute), keys, ["_minute"], raw.columns)


def mark_imported_keyed(keyed: DataFrame, minute_fact: DataFrame) -> DataFrame:
    """Flag keyed rows whose (date, minute) occurs in the minute fact, in any zone."""
    loaded = keyed_ops.loaded_minutes(minute_fact)
    keys = loaded.select(
        "calendar_id", F.col("time_id").alias("_minute"), F.lit(True).alias("_loaded")
    )
    staged = keyed.withColumn("_minute", keyed_ops.minute_key())
    return _flag(staged, keys, ["calendar_id", "_minute"], keyed.columns)


def _flag(rows: DataFrame, keys: DataFrame, on: Sequence[str], columns: list[str]) -> DataFrame:
    """Adaptive execution broadcasts the keys by their measured bytes, or splits a hot one."""
    joined = rows.join(keys, list(on), "left")
    flag = F.col("imported") | F.coalesce(F.col("_loaded"), F.lit(False))
    return joined.withColumn("imported", flag).select(*columns)


def reset_imported(df: DataFrame) -> DataFrame:
    return df.withColumn("imported", F.lit(False))


# ---- load of closed minutes -----------------------------------------------------

class Load(NamedTuple):
    """Results of one load, all from the same snapshot."""

    rows: DataFrame         # new averages: observe_date, node_model_id, sensor_value, node_unique_id
    quarantined: DataFrame  # averages the target cannot hold (NULL or out of range)
    raw: DataFrame          # raw rows with their new flags


def closed_averages(raw: DataFrame, models: DataFrame, as_of: datetime) -> DataFrame:
    """Averages of the not yet imported rows of closed minutes, in the stored type."""
    pending = gates.closed_minutes(gates.not_imported(raw), as_of)
    return rollup.minute_averages(pending, models).select(
        "observe_date",
        "node_model_id",
        F.col("sensor_value").try_cast(STORED_TYPE).alias("sensor_value"),
        "node_unique_id",
        F.col("sensor_value").isNotNull().alias("_has_value"),
    )


def split_averages(averages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(storable averages, quarantined averages with a reason)."""
    good = averages.filter(F.col("sensor_value").isNotNull()).drop("_has_value")
    reason = F.when(F.col("_has_value"), "out_of_range").otherwise("no_value")
    bad = averages.filter(F.col("sensor_value").isNull()).select(
        "observe_date", "node_model_id", "node_unique_id", reason.alias("reject_reason")
    )
    return good, bad


def flag_closed(raw: DataFrame, as_of: datetime) -> DataFrame:
    """Flags after a load, without a join.

    Every not-imported row of a closed minute takes part in the load (a scalar sensor
    yields a group even without a value), so its minute is among the loaded ones;
    rows already imported stay so.  Hence the flag depends on the row alone.
    """
    closed = gates.before_open_minute(raw, as_of)
    return raw.withColumn("imported", F.col("imported") | closed)


def load_closed(raw: DataFrame, models: DataFrame, as_of: datetime) -> Load:
    rows, bad = split_averages(closed_averages(raw, models, as_of))
    return Load(rows, bad, flag_closed(raw, as_of))


class KeyedLoad(NamedTuple):
    rows: DataFrame
    raw: DataFrame


def load_closed_keyed(keyed: DataFrame, as_of: datetime, wrap: bool = False) -> KeyedLoad:
    """Keyed form of the load; flags exactly the rows that were averaged."""
    taken = (
        calendar.in_calendar(F.col("calendar_id"))
        & clock.in_day(F.col("time_id"))
        & gates.closed_local_minute(as_of, wrap)
    )
    flagged = keyed.withColumn("imported", F.col("imported") | taken)
    return KeyedLoad(keyed_ops.minute_rollup(keyed, as_of, wrap), flagged)


def touched_days(raw: DataFrame, as_of: datetime) -> DataFrame:
    """Days in which a load changes flags."""
    pending = gates.closed_minutes(gates.not_imported(raw), as_of)
    return pending.select(F.col("observe_date").cast("date").alias("obs_day")).distinct()


# ---- upsert, retention, acknowledgement, receipts --------------------------------

def upsert(
    old: DataFrame, new: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """New rows replace old rows of equal key, all others stay.

    With plain equality a NULL key column never matches, so such rows pile up as
    under a UNIQUE constraint; ``null_safe`` lets NULL equal NULL.
    """
    new = new.select(*old.columns)
    nullable = [k for k in keys if old.schema[k].dataType.simpleString() == "string"]
    if not null_safe:
        replaced = new.select(*keys).distinct()
        kept = old.join(replaced, list(keys), "left_anti")
        return kept.unionByName(new)
    plain = [k for k in keys if k not in nullable]
    marks = {f"_k_{k}": F.coalesce(F.concat(F.lit("="), F.col(k)), F.lit("")) for k in nullable}
    replaced = new.withColumns(marks).select(*plain, *marks).distinct()
    kept = old.withColumns(marks).join(replaced, [*plain, *marks], "left_anti")
    return kept.select(*old.columns).unionByName(new)


def retain(raw: DataFrame, as_of: datetime, hours: int = RETENTION_HOURS) -> DataFrame:
    """Raw rows that are not expired."""
    return raw.filter(~gates.expired(raw, as_of, hours))


def expired_rows(raw: DataFrame, as_of: datetime, hours: int = RETENTION_HOURS) -> DataFrame:
    return raw.filter(gates.expired(raw, as_of, hours))


def apply_acks(rollup_rows: DataFrame, acks: DataFrame) -> DataFrame:
    """Flag acknowledged averages as delivered."""
    acked = acks.select("id", F.lit(True).alias("_loaded")).distinct()
    return _flag(rollup_rows, acked, ["id"], rollup_rows.columns)


def as_receipts(rows: DataFrame) -> DataFrame:
    """Receipts of any of the three forms: (end), (end, sensor), (end, sensor, node)."""
    columns = [F.col("end_15min").cast("timestamp").alias("end_15min")]
    columns.append(
        F.col("sensor_name") if "sensor_name" in rows.columns
        else F.lit("").alias("sensor_name")
    )
    columns.append(
        F.col("node_unique_id") if "node_unique_id" in rows.columns
        else F.lit(None).cast("string").alias("node_unique_id")
    )
    return rows.select(*columns)


def record_receipts(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Delivery log with the new receipts, each once."""
    return existing.select(*RECEIPT_KEYS).unionByName(new_receipts(existing, rows))


def new_receipts(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Receipts that the log does not hold yet, to be appended; the log itself stays."""
    fresh, log = as_receipts(rows).distinct().alias("fresh"), existing.alias("log")
    same = [F.col(f"fresh.{k}").eqNullSafe(F.col(f"log.{k}")) for k in RECEIPT_KEYS]
    return fresh.join(log, same[0] & same[1] & same[2], "left_anti")


# ---- schema evolution -----------------------------------------------------------

def add_column(df: DataFrame, name: str, default: Column) -> DataFrame:
    """New column with one value for all existing rows; an existing column stays."""
    return df if name in df.columns else df.withColumn(name, default)


def fill_empty(df: DataFrame, name: str, value: str = "") -> DataFrame:
    return df.fillna({name: value})


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)
