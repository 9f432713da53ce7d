"""Scheduled jobs over stored, day-partitioned tables.

The jobs of one table set run one after another (one writer at a time).  Each can be
repeated after a failure with the same label (``delivery``, ``as_of``) without changing
the outcome: what a job is about to do (its first id, the rows it takes) is recorded
beside the table before it does it, and a repetition goes by the record.  An append that
died half way is finished by whatever job comes next (``settle``), before it does its own
work.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugemill import schemas
from gaugemill.constants import LINES_PER_BATCH, RETENTION_HOURS
from gaugemill.functions import clock
from gaugemill.operators import batching, gates, readings, state
from gaugemill.plans import ledger
from gaugemill.plans.ledger import Entry, Ledger
from gaugemill.session import discard, folders, materialize, remove_folder
from gaugemill.sources import contracts, observations as store
from gaugemill.streaming import runner
from gaugemill.streaming.count_window import CountWindow

LOAD_RECORD = "id long, obs_day date, first long"
SNAPSHOT = "raw_high long"
LOAD_MARK = "as_of timestamp, raw_high long, pending_day date"
REJECTED_AVERAGES = "observe_date timestamp, node_model_id int, node_unique_id string, reject_reason string"
REJECTED_VALUES = "id long, sensor_name string, node_unique_id string, text string"


def highest_id(table: DataFrame) -> int:
    """Largest id in use, 0 for an empty table; Parquet answers from file statistics."""
    return table.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def _next_start(spark: SparkSession, path: str) -> int:
    """The id that new rows follow: above all planned ones and all in the table."""
    table = ledger.stored(spark, path, "id long")
    return max(0 if table is None else highest_id(table), Ledger(spark, path).high_water())


def ingest(
    lines: DataFrame, raw_path: str, start: int | None = None, firmware: str = "expanded",
    delivery: str | None = None,
) -> None:
    """Lines of one complete delivery to appended raw observations.

    Ids follow ``start``, by default the highest id ever given out.  A delivery with a
    label is appended once, however often it is ingested and whatever retention has removed
    since.  Lines of an unfinished batch are left out; where deliveries continue each other,
    use the streaming count window.
    """
    spark = lines.sparkSession
    contracts.require(lines, schemas.LINES)
    settle(spark, raw_path)
    if delivery and Ledger(spark, raw_path).find(delivery):
        return
    observations = materialize(
        batching.assemble(batching.count_windows(lines, LINES_PER_BATCH[firmware])), "assembled"
    )
    append_once(observations, raw_path, delivery, start)
    discard(observations)


def append_once(
    observations: DataFrame, raw_path: str, delivery: str | None, start: int | None = None
) -> None:
    """Append observations (station, batch_no, ...) under new ids, once per label.

    The rows are staged, then planned in the ledger, then appended, then marked as done.
    Up to the plan nothing has happened; after it the staged rows are appended exactly once,
    by this call, by a repetition, or by ``settle``.
    """
    spark = observations.sparkSession
    book = Ledger(spark, raw_path)
    label = delivery or f"unlabelled-{uuid.uuid4().hex}"
    settle(spark, raw_path)
    if book.find(label):
        return
    first = _next_start(spark, raw_path) if start is None else start
    staged = _staged_path(raw_path, label)
    state.observation_ids(observations, first).select(
        F.col("id").cast("long").alias("id"), F.col("observe_date").cast("timestamp").alias("observe_date"),
        "sensor_values",
    ).write.mode("overwrite").parquet(staged)
    n, lowest = spark.read.schema(STAGED).parquet(staged).agg(
        F.count(F.lit(1)), F.min("observe_date").cast("date")
    ).first()
    _append_planned(spark, raw_path, book.plan(label, first, n, lowest), repeated=False)


STAGED = "id long, observe_date timestamp, sensor_values string"


def _staged_path(raw_path: str, label: str) -> str:
    return f"{raw_path}_jobs/staged/{uuid.uuid5(uuid.NAMESPACE_URL, label).hex}"


def _append_planned(spark: SparkSession, raw_path: str, entry: Entry, repeated: bool) -> None:
    """Append the staged rows of a planned entry; after a failure, in place of what it left."""
    staged = _staged_path(raw_path, entry.label)
    rows = spark.read.schema(STAGED).parquet(staged)
    if repeated and (raw := ledger.stored(spark, raw_path, store.stored_schema(schemas.OBSERVATION_RAW))) is not None:
        mine = F.col("id").between(entry.first + 1, entry.first + entry.n)
        # Only the delivery's own days are looked through.
        days = rows.select(F.col("observe_date").cast("date").alias(store.DAY)).distinct()
        left = raw.join(F.broadcast(days), store.DAY, "left_semi")
        hit = left.filter(mine).select(store.DAY).distinct()
        kept = materialize(
            left.join(F.broadcast(hit), store.DAY, "left_semi").filter(~mine), "before_append"
        )
        gone = [r[0] for r in hit.join(kept.select(store.DAY).distinct(), store.DAY, "left_anti").collect()]
        store.overwrite_days(kept.select(*schemas.OBSERVATION_RAW.fieldNames()), raw_path)
        store.drop_days(spark, raw_path, gone)
        discard(kept)
    store.append_raw(rows, raw_path)
    Ledger(spark, raw_path).finish(entry)
    remove_folder(spark, staged)


def settle(spark: SparkSession, raw_path: str) -> None:
    """Finish appends that were planned but not done, before anything reads the table."""
    for entry in Ledger(spark, raw_path).unfinished():
        _append_planned(spark, raw_path, entry, repeated=True)


class StreamIngest:
    """``foreachBatch`` step from a line stream to the raw table.

    Count windows keep unfinished batches for the next micro-batch; full ones are
    appended under dense ids, once per micro-batch, so a replay changes nothing.
    """

    def __init__(self, spark: SparkSession, raw_path: str, size: int, work: str, label: str):
        self.window = CountWindow(spark, size, f"{work}/windows", f"{work}/state")
        self.raw_path = raw_path
        self.label = label

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        self.window(lines, batch_id)
        append_once(self.window.observations(batch_id), self.raw_path, f"{self.label}-{batch_id}")


def load(
    spark: SparkSession, raw_path: str, rollup_path: str, models: DataFrame, as_of: datetime,
    start: int | None = None,
) -> DataFrame:
    """Closed minutes to the rollup table, flags on the raw rows; returns the quarantine.

    The ids of the rows that the load takes are recorded first.  Averages and flags go
    by that record, so a row delivered meanwhile is neither averaged nor flagged, and a
    repetition with the same ``as_of`` rewrites the same folders with the same ids.
    What can't be stored is kept beside the rollup: averages and, with the text, single
    values (``read_rejected_values``).
    """
    settle(spark, raw_path)
    settle_folds(spark, rollup_path)
    contracts.require(spark.read.parquet(raw_path).drop(store.DAY), schemas.OBSERVATION_RAW)
    label = store.load_label(as_of)
    taken = _taken(spark, raw_path, rollup_path, as_of, label, start)
    first, lowest = taken.agg(F.coalesce(F.min("first"), F.lit(0)), F.min("obs_day")).first()
    since = datetime.combine(lowest, datetime.min.time()) if lowest else as_of
    raw = store.scan_raw(spark, raw_path, since=since, before=as_of).join(
        taken.select("id"), "id", "left_semi"
    )
    rows = materialize(state.reset_imported(raw), "taken")
    averages = materialize(state.closed_averages(rows, models, as_of), "averages")
    good, bad = state.split_averages(averages)
    bad.write.mode("overwrite").parquet(f"{rollup_path}_jobs/rejected_averages/load_at={label}")
    readings.quarantined(rows).write.mode("overwrite").parquet(
        f"{rollup_path}_jobs/rejected_values/load_at={label}"
    )
    book = Ledger(spark, rollup_path)
    if (entry := book.find(f"load-{label}")) is None:
        entry = book.plan(f"load-{label}", first, good.count(), lowest)
    if not entry.done:  # a load that is done may have been folded since
        store.write_load(state.rollup_ids(good, first), rollup_path, as_of)
        book.finish(entry)
    mark(spark, raw_path, taken)
    _record_load(spark, rollup_path, as_of)
    return spark.read.schema(REJECTED_AVERAGES).parquet(
        f"{rollup_path}_jobs/rejected_averages/load_at={label}"
    )


def _taken(spark, raw_path, rollup_path, as_of, label, start) -> DataFrame:
    """The record of a load: its rows' ids and days, and the id its averages follow."""
    path = f"{rollup_path}_jobs/taken/load_at={label}"
    snapshot = f"{rollup_path}_jobs/snapshots/load_at={label}"
    known = ledger.stored(spark, path, LOAD_RECORD)
    if known is not None:
        return known
    first = _next_start(spark, rollup_path) if start is None else start
    high = spark.createDataFrame([(Ledger(spark, raw_path).high_water(),)], SNAPSHOT)
    high.coalesce(1).write.mode("overwrite").parquet(snapshot)
    raw = store.scan_raw(spark, raw_path, since=pending_since(spark, raw_path, rollup_path), before=as_of)
    pending = gates.closed_minutes(gates.not_imported(raw), as_of)
    record = pending.select("id", F.col(store.DAY).alias("obs_day"), F.lit(first).cast("long").alias("first"))
    record.write.mode("overwrite").parquet(path)
    return spark.read.schema(LOAD_RECORD).parquet(path)


def _record_load(spark: SparkSession, rollup_path: str, as_of: datetime) -> None:
    """Note that nothing before the day of ``as_of`` is pending among the ids the load saw."""
    now = clock.naive_utc(as_of)
    label = store.load_label(as_of)
    raw_high = spark.read.schema(SNAPSHOT).parquet(f"{rollup_path}_jobs/snapshots/load_at={label}").first()[0]
    row = spark.createDataFrame([(now, raw_high, now.date())], LOAD_MARK).coalesce(1)
    row.write.mode("overwrite").parquet(f"{rollup_path}_jobs/marks/load_at={label}")


def pending_since(spark: SparkSession, raw_path: str, rollup_path: str) -> datetime | None:
    """Start of the earliest day that can hold pending rows; None where that is not known.

    A load takes every closed minute, so what it leaves is of its own day or later; rows
    delivered since may be older, and the ledger has the earliest day of each delivery.
    Rows that came into the table past the ledger leave no lower bound.
    """
    marks = ledger.stored(spark, f"{rollup_path}_jobs/marks", LOAD_MARK)
    last = None if marks is None else marks.orderBy(F.desc("as_of")).first()
    table = ledger.stored(spark, raw_path, "id long")
    book = Ledger(spark, raw_path)
    if last is None or table is None or highest_id(table) > book.high_water():
        return None
    days: list[date] = [last["pending_day"]]
    if (later := book.lowest_day_after(last["raw_high"])) is not None:
        days.append(later)
    return datetime.combine(min(days), datetime.min.time())


def read_rejected_values(spark: SparkSession, rollup_path: str) -> DataFrame:
    """Values of all loads that are no reading: (id, sensor_name, node_unique_id, text, load_at)."""
    return spark.read.schema(REJECTED_VALUES + ", load_at string").parquet(
        f"{rollup_path}_jobs/rejected_values"
    )


def mark(spark: SparkSession, raw_path: str, taken: DataFrame) -> None:
    """Set the flags of the recorded rows, rewriting only days that hold such rows."""
    days = taken.select(F.col("obs_day").alias(store.DAY)).distinct()  # one row per calendar day
    affected = store.scan_raw(spark, raw_path).join(F.broadcast(days), store.DAY, "left_semi")
    flagged = state.apply_acks(affected, taken).select(*schemas.OBSERVATION_RAW.fieldNames())
    store.overwrite_days(materialize(flagged, "flagged"), raw_path)


def acknowledge(spark: SparkSession, rollup_path: str, acked: DataFrame) -> None:
    """Note delivered averages in a small file of their own; the rollup is not touched.

    ``read_rollup`` reads the rollup through these notes, ``fold_acks`` moves them into it.
    """
    store.append_acks(acked, rollup_path)


def fold_acks(spark: SparkSession, rollup_path: str) -> None:
    """Move the noted acknowledgements into the flags of the loads they belong to.

    Only loads that hold newly acknowledged rows are rewritten, then the notes that were
    read are removed.  In between a row is acknowledged twice, which is no different.
    """
    settle_folds(spark, rollup_path)
    notes = folders(spark, store.acks_path(rollup_path))
    if not notes:
        return
    acked = materialize(spark.read.schema(store.ACKS).parquet(*notes).distinct(), "acks")
    rollup = store.read_rollup(spark, rollup_path, with_acks=False)
    touched = (
        rollup.select("id", "imported", *store.LOAD_KEYS)
        .join(acked, "id", "left_semi").filter("not imported").select(*store.LOAD_KEYS).distinct()
    )
    affected = rollup.join(touched, store.LOAD_KEYS, "left_semi")
    flagged = materialize(state.apply_acks(affected, acked), "acked")
    store.overwrite_loads(flagged, rollup_path)
    for note in notes:
        remove_folder(spark, note)
    discard(flagged)
    discard(acked)


FOLDED = "folded"


def fold_loads(spark: SparkSession, rollup_path: str, before: date | None = None) -> None:
    """Merge the load folders of each day (of days before ``before``) into one, sorted by time.

    The merged rows are staged and planned before the first folder is replaced, so a fold
    that dies is finished by the next job.  A load that is repeated after it was folded is
    known by its ledger entry and written no more.
    """
    settle_folds(spark, rollup_path)
    days = []
    for folder in folders(spark, rollup_path):
        day = date.fromisoformat(folder.rsplit("=", 1)[1])
        if (before is None or day < before) and len(folders(spark, folder)) > 1:
            days.append(day)
    if not days:
        return
    rows = store.read_rollup(spark, rollup_path, with_acks=False).filter(F.col(store.DAY).isin(days))
    work = _folding(rollup_path)
    rows.withColumn(store.LOAD, F.lit(FOLDED)).write.mode("overwrite").parquet(f"{work}/rows")
    plan = spark.createDataFrame([(d,) for d in days], f"{store.DAY} date").coalesce(1)
    plan.write.mode("overwrite").parquet(f"{work}/plan")
    settle_folds(spark, rollup_path)


def _folding(rollup_path: str) -> str:
    return f"{rollup_path}_jobs/folding"


def settle_folds(spark: SparkSession, rollup_path: str) -> None:
    """Put a planned fold's rows in the place of the folders they come from."""
    work = _folding(rollup_path)
    plan = ledger.stored(spark, f"{work}/plan", f"{store.DAY} date")
    days = [] if plan is None else [r[0] for r in plan.collect()]  # one row per calendar day
    if days:
        schema = store.stored_schema(schemas.OBSERVATION).add(store.LOAD, "string")
        store.overwrite_loads(spark.read.schema(schema).parquet(f"{work}/rows"), rollup_path)
        for day in days:
            for folder in folders(spark, f"{rollup_path}/{store.DAY}={day.isoformat()}"):
                if not folder.endswith(f"={FOLDED}"):
                    remove_folder(spark, folder)
        remove_folder(spark, f"{work}/plan")
        remove_folder(spark, f"{work}/rows")


GENERATION = "number int"


def current_rollup(spark: SparkSession, root: str) -> str:
    """Path of the rollup generation that is in use; generation 0 before any reprocessing."""
    pointers = ledger.stored(spark, f"{root}/pointers/*", GENERATION)
    number = 0 if pointers is None else pointers.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    return f"{root}/generation-{number}"


def reprocess_in_place(spark: SparkSession, raw_path: str, root: str, models: DataFrame, as_of: datetime) -> str:
    """Every closed minute again, flags or not, into a new generation; its path.

    The raw table is read where it lies and nothing of it is copied or reset.  The pointer
    is set once the new generation is complete; until then readers see the old one.  Rows of
    closed minutes that no load had taken yet are flagged afterwards, as a load does.
    """
    settle(spark, raw_path)
    number = int(current_rollup(spark, root).rsplit("-", 1)[1]) + 1
    path = f"{root}/generation-{number}"
    remove_folder(spark, path)  # of a run that died before it set the pointer
    remove_folder(spark, f"{path}_jobs")
    label = store.load_label(as_of)
    high = spark.createDataFrame([(Ledger(spark, raw_path).high_water(),)], SNAPSHOT)
    high.coalesce(1).write.mode("overwrite").parquet(f"{path}_jobs/snapshots/load_at={label}")
    raw = store.scan_raw(spark, raw_path, before=as_of)
    closed = gates.closed_minutes(raw, as_of)
    new = closed.filter("not imported").select("id", F.col(store.DAY).alias("obs_day"))
    taken = materialize(new, "reprocess_taken")
    averages = materialize(state.closed_averages(state.reset_imported(closed), models, as_of), "averages")
    good, bad = state.split_averages(averages)
    bad.write.mode("overwrite").parquet(f"{path}_jobs/rejected_averages/load_at={label}")
    store.write_load(state.rollup_ids(good, 0), path, as_of)
    book = Ledger(spark, path)
    book.finish(book.plan(f"load-{label}", 0, good.count(), None))
    _record_load(spark, path, as_of)
    pointer = spark.createDataFrame([(number,)], GENERATION).coalesce(1)
    pointer.write.mode("overwrite").parquet(f"{root}/pointers/{number}")
    if not taken.isEmpty():
        mark(spark, raw_path, taken)
    return path


def expire(
    spark: SparkSession, raw_path: str, as_of: datetime, hours: int = RETENTION_HOURS
) -> None:
    """Remove expired rows in place.

    Only days up to the retention bound are read.  Of these, days without expired rows
    keep their files, days that keep some rows are rewritten, and the folders of days
    that keep none are dropped.
    """
    settle(spark, raw_path)
    bound = clock.naive_utc(clock.hours_before(as_of, hours))
    old = store.scan_raw(spark, raw_path).filter(F.col(store.DAY) <= F.lit(bound.date()))
    days = old.filter(gates.expired(old, as_of, hours)).select(store.DAY).distinct()
    touched = materialize(old.join(F.broadcast(days), store.DAY, "left_semi"), "touched")
    kept = state.retain(touched, as_of, hours)
    left = {r[0] for r in kept.select(store.DAY).distinct().collect()}
    gone = [r[0] for r in touched.select(store.DAY).distinct().collect() if r[0] not in left]
    if left:
        store.overwrite_days(kept.select(*schemas.OBSERVATION_RAW.fieldNames()), raw_path)
    store.drop_days(spark, raw_path, gone)


def clean(
    spark: SparkSession, raw_path: str, kept_path: str, as_of: datetime,
    hours: int = RETENTION_HOURS,
) -> None:
    """Write the raw table without expired rows to a new place, replacing what is there.

    Days after the retention bound cannot hold expired rows; they are copied as
    they are, only older days are filtered row by row.  ``expire`` works in place.
    """
    settle(spark, raw_path)
    raw = store.scan_raw(spark, raw_path)
    bound = clock.hours_before(as_of, hours).date()
    expired = (F.col(store.DAY) <= F.lit(bound)) & gates.expired(raw, as_of, hours)
    store.overwrite_days(raw.filter(~expired).select(*schemas.OBSERVATION_RAW.fieldNames()), kept_path)


def reprocess(
    spark: SparkSession, raw_path: str, new_raw_path: str, new_rollup_path: str,
    models: DataFrame, as_of: datetime,
) -> DataFrame:
    """Everything again from raw: flags cleared, rollup rebuilt from empty."""
    settle(spark, raw_path)
    raw = store.scan_raw(spark, raw_path).select(*schemas.OBSERVATION_RAW.fieldNames())
    store.overwrite_days(state.reset_imported(raw), new_raw_path)
    return load(spark, new_raw_path, new_rollup_path, models, as_of, start=0)


def on_cadence(
    spark: SparkSession, step: Callable[[datetime], None], checkpoint: str,
    now: Callable[[], datetime],
) -> StreamingQuery:
    """Run ``step(now())`` on the service's cadence, for the rollup and the cleanup alike.

    A clock stream triggers it; a run that takes longer than the interval delays the
    next one, and two runs never overlap.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return runner.every_minute(runner.per_batch(ticks, lambda _, __: step(now()), checkpoint))
