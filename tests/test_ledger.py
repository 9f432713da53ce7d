"""Ids and deliveries that outlive their rows, notes of acknowledgements, the delivery loop, sealed logs."""

from datetime import date, datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from gaugemill.operators import gates
from gaugemill.plans import delivery, jobs
from gaugemill.plans.ledger import Ledger
from gaugemill.session import folders, scratch_path
from gaugemill.sources import dimensions, minutes, observations, testbed, versions
from gaugemill.streaming import late

AS_OF = datetime(2024, 1, 2, 12, 0, 30)


def observed(spark, *days, station="a"):
    rows = [(station, i, datetime(2024, 1, day, 6, i % 60), '{"dht11_t": 1.5}') for i, day in enumerate(days)]
    return spark.createDataFrame(
        rows, "station string, batch_no long, observe_date timestamp, sensor_values string")


def ids(spark, path):
    return sorted(r.id for r in observations.scan_raw(spark, path, columns=["id"]).collect())


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


@pytest.fixture()
def raw_path(spark):
    return scratch_path(spark, "ledger-raw")


@pytest.fixture()
def rollup_path(spark):
    return scratch_path(spark, "ledger-rollup")


@pytest.fixture(scope="module")
def models(spark):
    return dimensions.node_models(spark)


def test_a_delivery_stays_known_after_retention(spark, raw_path, rollup_path, models):
    jobs.append_once(observed(spark, 1, 2, 2), raw_path, "x")
    jobs.load(spark, raw_path, rollup_path, models, AS_OF)
    jobs.expire(spark, raw_path, AS_OF)
    assert ids(spark, raw_path) == [2, 3]
    jobs.append_once(observed(spark, 1, 2, 2), raw_path, "x")
    assert ids(spark, raw_path) == [2, 3]


def test_ids_rise_after_everything_expired(spark, raw_path, rollup_path, models):
    jobs.append_once(observed(spark, 1, 1), raw_path, None)
    jobs.load(spark, raw_path, rollup_path, models, AS_OF)
    jobs.expire(spark, raw_path, AS_OF + timedelta(days=3))
    jobs.append_once(observed(spark, 1, 2), raw_path, None)
    assert ids(spark, raw_path) == [3, 4]
    # the older row is found again, though it lies before what the last load left
    jobs.load(spark, raw_path, rollup_path, models, AS_OF + timedelta(minutes=1))
    assert observations.scan_raw(spark, raw_path).filter("not imported").isEmpty()


@pytest.mark.parametrize("left", [0, 1, 3])
@pytest.mark.parametrize("next_job", ["repeat", "other", "load"])
def test_an_append_that_died_is_finished_once(spark, raw_path, rollup_path, models, monkeypatch, left, next_job):
    """Of three planned rows none, one or all are in the table when the job dies."""
    jobs.append_once(observed(spark, 1, 1), raw_path, "before")
    append = observations.append_raw

    def dies(rows, path):
        if left:
            append(rows.filter(F.col("id") <= 2 + left), path)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(observations, "append_raw", dies)
        with pytest.raises(RuntimeError):
            jobs.append_once(observed(spark, 1, 2, 2), raw_path, "x")
    if next_job == "load":
        jobs.load(spark, raw_path, rollup_path, models, AS_OF)
    else:
        jobs.append_once(observed(spark, 1, 2, 2), raw_path, "x" if next_job == "repeat" else "y")
    assert ids(spark, raw_path) == list(range(1, 9 if next_job == "other" else 6))
    assert not Ledger(spark, raw_path).unfinished()


def test_the_ledger_folds_its_entries(spark, raw_path):
    book = Ledger(spark, raw_path)
    for i in range(5):
        book.finish(book.plan(f"d/{i}", 10 * i, 10, date(2024, 1, 1 + i)))
    book.plan("open", 50, 0, None)
    before = book.entries().orderBy("label").collect()
    for _ in range(2):
        book.fold()
        assert len(folders(spark, book.path)) == 1
        assert book.entries().orderBy("label").collect() == before
    assert (book.high_water(), book.lowest_day_after(20)) == (50, date(2024, 1, 3))
    assert [e.label for e in book.unfinished()] == ["open"]


def test_a_load_reads_pending_days_only(spark, raw_path, rollup_path, models, monkeypatch):
    jobs.append_once(observed(spark, 1, 1), raw_path, None)
    assert jobs.pending_since(spark, raw_path, rollup_path) is None
    jobs.load(spark, raw_path, rollup_path, models, AS_OF)
    assert jobs.pending_since(spark, raw_path, rollup_path) == datetime(2024, 1, 2)
    jobs.append_once(observed(spark, 1, 2), raw_path, None)
    assert jobs.pending_since(spark, raw_path, rollup_path) == datetime(2024, 1, 1)

    scans, scan = [], observations.scan_raw

    def seen(*args, **kwargs):
        scans.append(scan(*args, **kwargs))
        return scans[-1]

    monkeypatch.setattr(observations, "scan_raw", seen)
    jobs.load(spark, raw_path, rollup_path, models, AS_OF + timedelta(minutes=1))
    filters = next(line for line in plan_of(scans[0]).splitlines() if "PartitionFilters" in line)
    assert "(obs_day" in filters and ">= 2024-01-01" in filters and "<= 2024-01-02" in filters
    # rows past the ledger leave no lower bound
    monkeypatch.undo()
    observations.append_raw(spark.createDataFrame(
        [(99, datetime(2023, 12, 31), "{}")], "id long, observe_date timestamp, sensor_values string"), raw_path)
    assert jobs.pending_since(spark, raw_path, rollup_path) is None


@pytest.fixture()
def loaded(spark, sf_dir, raw_path, rollup_path, models):
    observations.append_by_day(testbed.raw(spark, sf_dir), raw_path)
    jobs.load(spark, raw_path, rollup_path, models, testbed.AS_OF)
    return rollup_path


def test_acknowledging_writes_a_note_only(spark, loaded):
    stored = observations.read_rollup(spark, loaded)
    before, total = files(stored), stored.count()
    newest = stored.orderBy(F.desc("id")).limit(25)
    acked = {r.id for r in newest.collect()}
    jobs.acknowledge(spark, loaded, newest)
    jobs.acknowledge(spark, loaded, newest)
    assert files(observations.read_rollup(spark, loaded, with_acks=False)) == before
    for _ in range(2):
        now = observations.read_rollup(spark, loaded)
        assert now.count() == total
        assert {r.id for r in now.filter("imported").collect()} == acked
        jobs.fold_acks(spark, loaded)
        assert folders(spark, observations.acks_path(loaded)) == []


def test_the_delivery_loop_goes_on_where_it_died(spark, loaded, models, monkeypatch):
    def send(documents, number):
        assert documents.columns == ["id", "observation_data"]
        return documents.select("id", F.lit(201).alias("status_code"))

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "acknowledge", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            delivery.send_round(spark, loaded, models, send, testbed.AS_OF)
    assert delivery.drain(spark, loaded, models, send, testbed.AS_OF)
    stored = observations.read_rollup(spark, loaded)
    assert gates.not_imported(stored).isEmpty()
    counts = delivery.attempt_counts(delivery.read_attempts(spark, loaded))
    assert counts.count() == stored.count() and counts.filter("attempts <> 1").isEmpty()


def test_unknown_address_waits_and_refusal_stops(spark, loaded, models):
    def send(documents, number):
        return documents.select("id", F.lit({1: 404, 2: 201}.get(number, 401)).alias("status_code"))

    now = testbed.AS_OF
    assert delivery.send_round(spark, loaded, models, send, now) == {"retry": 25}
    first = {r.id for r in delivery.read_attempts(spark, loaded).collect()}
    # ten seconds later others are sent, the first wait
    assert delivery.send_round(spark, loaded, models, send, now + timedelta(seconds=10)) == {"acked": 25}
    assert not first & {r.id for r in delivery.read_attempts(spark, loaded).filter("round = 2").collect()}
    assert delivery.drain(spark, loaded, models, send, now + timedelta(seconds=30)) is False
    last = delivery.read_attempts(spark, loaded).filter("round = 3").collect()
    assert [r.outcome for r in last] == ["fatal"] and last[0].id in first


def test_a_sealed_log_reads_the_same(spark, sf_dir, monkeypatch):
    raw = testbed.raw(spark, sf_dir)
    log = scratch_path(spark, "partials")
    step = late.PartialLog(log)
    parts = [raw.filter(F.col("id") % 6 == n) for n in range(6)]

    def shown():
        read = late.read_log(spark, log)
        return [sorted(map(str, df.collect())) for df in (
            read, late.append_policy(read), late.overwrite_policy(read), late.exact_policy(read))]

    for n, part in enumerate(parts):
        step(part, n)
        if n in (2, 4):
            before = shown()
            if n == 2:  # dies before anything is removed
                monkeypatch.setattr(late, "_remove_replaced", lambda *_: None)
            late.seal(spark, log, upto=n)
            monkeypatch.undo()
            assert shown() == before
            late.seal(spark, log, upto=n)
            assert shown() == before
            if n == 4:
                assert len(folders(spark, f"{log}/open")) == 0
    step(parts[4], 5)
    step(parts[5], 5)  # a replay
    assert len(folders(spark, f"{log}/open")) == 1
    days = folders(spark, f"{log}/sealed")
    assert days and all(len(folders(spark, day)) == 1 for day in days)
    pruned = late.read_log(spark, log, since=date(2024, 1, 2), before=date(2024, 1, 3))
    assert plan_of(pruned).count("PartitionFilters: [isnotnull(obs_day") >= 2


def test_folding_loads_keeps_rows_and_labels(spark, sf_dir, raw_path, rollup_path, models, monkeypatch):
    observations.append_by_day(testbed.raw(spark, sf_dir), raw_path)
    times = [testbed.AS_OF - timedelta(hours=2), testbed.AS_OF]
    for as_of in times:
        jobs.load(spark, raw_path, rollup_path, models, as_of)
    acked = observations.read_rollup(spark, rollup_path).orderBy("id").limit(3)
    jobs.acknowledge(spark, rollup_path, acked)

    def shown():
        return sorted(map(str, observations.read_rollup(spark, rollup_path).drop("load_at").collect()))

    before = shown()
    with monkeypatch.context() as patch:  # dies between the plan and the first folder
        patch.setattr(observations, "overwrite_loads", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.fold_loads(spark, rollup_path)
    assert shown() == before
    jobs.load(spark, raw_path, rollup_path, models, times[0])  # finishes the fold, writes nothing again
    for _ in range(2):
        assert shown() == before
        assert all(len(folders(spark, day)) == 1 for day in folders(spark, rollup_path))
        jobs.fold_loads(spark, rollup_path)
    jobs.fold_acks(spark, rollup_path)
    assert shown() == before


def test_reprocessing_copies_no_raw_row(spark, sf_dir, raw_path, models):
    root = scratch_path(spark, "generations")
    observations.append_by_day(testbed.raw(spark, sf_dir), raw_path)
    first = jobs.current_rollup(spark, root)
    jobs.load(spark, raw_path, first, models, testbed.AS_OF)
    before = files(observations.scan_raw(spark, raw_path))
    path = jobs.reprocess_in_place(spark, raw_path, root, models, testbed.AS_OF)
    assert path == jobs.current_rollup(spark, root) != first
    assert files(observations.scan_raw(spark, raw_path)) == before
    # the next load goes on behind it, and takes nothing twice
    jobs.load(spark, raw_path, path, models, testbed.AS_OF + timedelta(days=1))
    rollup = observations.read_rollup(spark, path)
    assert rollup.select("id").distinct().count() == rollup.count()
    assert rollup.groupBy("observe_date", "node_model_id", "node_unique_id").count().filter("count > 1").isEmpty()


def test_an_upsert_leaves_other_folders_alone(spark):
    path = scratch_path(spark, "fact")
    columns = ("calendar_id int, time_id int, timezone string, sensor_name string, "
               "node_unique_id string, sensor_value double")

    def table(*rows):
        return spark.createDataFrame([(d, t, "UTC", s, n, v) for d, t, s, n, v in rows], columns)

    minutes.upsert_fact(table((1, 0, "a", "x", 1.0), (1, 0, "b", "x", 1.0), (2, 0, "a", "x", 1.0), (2, 0, "a", None, 1.0)), path)
    before = {(r.calendar_id, r.sensor_name): files(minutes.read_fact(spark, path).filter(
        (F.col("calendar_id") == r.calendar_id) & (F.col("sensor_name") == r.sensor_name)))
        for r in minutes.read_fact(spark, path).collect()}
    for _ in range(2):
        minutes.upsert_fact(table((1, 0, "a", "x", 5.0), (1, 1, "a", "x", 6.0)), path, null_safe=True)
    fact = minutes.read_fact(spark, path)
    assert sorted((r.calendar_id, r.time_id, r.sensor_name, float(r.sensor_value)) for r in fact.collect()) == [
        (1, 0, "a", 5.0), (1, 0, "b", 1.0), (1, 1, "a", 6.0), (2, 0, "a", 1.0), (2, 0, "a", 1.0)]
    for key in ((1, "b"), (2, "a")):
        assert files(fact.filter((F.col("calendar_id") == key[0]) & (F.col("sensor_name") == key[1]))) == before[key]
    # a NULL part of the key matches only where it may
    minutes.upsert_fact(table((2, 0, "a", None, 7.0)), path, null_safe=True)
    assert minutes.read_fact(spark, path).count() == 5
    minutes.upsert_fact(table((2, 0, "a", None, 8.0)), path)
    assert minutes.read_fact(spark, path).count() == 6


def test_stored_nulls_are_no_defaults(spark):
    path = scratch_path(spark, "versions")
    columns = [versions.Evolved("k", "int"), versions.Evolved("gone", "string", until=3),
               versions.Evolved("s", "string", since=2, default="-")]
    rows = spark.createDataFrame([(1, "g", None), (2, "h", "s")], "k int, gone string, s string")
    for version in (1, 2, 3):
        versions.append_version(rows, path, columns, version)
    got = {v: sorted(map(str, map(tuple, versions.read_versions(spark, path, columns, v).collect()))) for v in (2, 3)}
    assert got[3] == sorted(map(str, [(1, "-"), (2, "-"), (1, None), (2, "s"), (1, None), (2, "s")]))
    assert sorted(versions.read_versions(spark, path, columns, 2).columns) == ["gone", "k", "s"]
