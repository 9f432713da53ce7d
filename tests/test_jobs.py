"""Jobs over stored tables: whole cycle, repetition after failure, invariants."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugemill import schemas
from gaugemill.operators import gates, outbox, state
from gaugemill.plans import jobs
from gaugemill.session import scratch_path
from gaugemill.sources import contracts, dimensions, generators, lines, observations, testbed

AS_OF = testbed.AS_OF


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


@pytest.fixture()
def tables(spark, sf_dir):
    raw_path, rollup_path = scratch_path(spark, "job-raw"), scratch_path(spark, "job-rollup")
    jobs.ingest(testbed.lines(spark, sf_dir), raw_path)
    return raw_path, rollup_path


def test_ingest_numbers_all_observations(spark, tables):
    raw = observations.scan_raw(spark, tables[0])
    count = raw.count()
    assert pairs(raw, "id") == [(i,) for i in sorted(range(1, count + 1), key=lambda i: str((i,)))]
    assert raw.filter("imported").isEmpty()
    assert contracts.differences(raw, schemas.OBSERVATION_RAW) == []


def test_load_can_be_repeated(spark, tables):
    raw_path, rollup_path = tables
    models = dimensions.node_models(spark)
    before = observations.scan_raw(spark, raw_path).count()
    expected = state.load_closed(observations.scan_raw(spark, raw_path), models, AS_OF)
    want = pairs(expected.rows, "observe_date", "node_model_id", "node_unique_id", "sensor_value")
    flags = pairs(expected.raw, "id", "imported")

    # the rollup is written, then the job dies before the flags are set
    good, _ = state.split_averages(
        state.closed_averages(observations.scan_raw(spark, raw_path, before=AS_OF), models, AS_OF)
    )
    observations.write_load(state.rollup_ids(good), rollup_path, AS_OF)
    jobs.load(spark, raw_path, rollup_path, models, AS_OF)

    rollup = observations.read_rollup(spark, rollup_path)
    assert pairs(rollup, "observe_date", "node_model_id", "node_unique_id", "sensor_value") == want
    assert rollup.select("id").distinct().count() == len(want)
    raw = observations.scan_raw(spark, raw_path)
    assert raw.count() == before
    assert pairs(raw, "id", "imported") == flags

    # a later load takes the rest, and nothing twice
    later = AS_OF + timedelta(days=1)
    jobs.load(spark, raw_path, rollup_path, models, later)
    rollup = observations.read_rollup(spark, rollup_path)
    assert rollup.count() > len(want)
    assert rollup.groupBy("observe_date", "node_model_id", "node_unique_id").count().filter(
        "count > 1"
    ).isEmpty()
    assert rollup.select("id").distinct().count() == rollup.count()
    assert observations.scan_raw(spark, raw_path).filter("not imported").isEmpty()


def test_ingest_of_a_labelled_delivery_happens_once(spark, sf_dir):
    raw_path = scratch_path(spark, "job-raw")
    some = testbed.lines(spark, sf_dir)
    for delivery in ("a", "a", "b", "a", "b"):
        jobs.ingest(some, raw_path, delivery=delivery)
    raw = observations.scan_raw(spark, raw_path)
    count = raw.count()
    assert count % 2 == 0 and raw.select("id").distinct().count() == count == jobs.highest_id(raw)


def test_load_takes_one_snapshot(spark, tables, monkeypatch):
    """A row delivered between averages and flags is left for the next load."""
    raw_path, rollup_path = tables
    models = dimensions.node_models(spark)
    late = spark.createDataFrame(
        [(10**6, datetime(2024, 1, 1, 2), '{"dht11_t": 1, "ds18b20_t_uq": [{"a": "bad"}]}')],
        "id long, observe_date timestamp, sensor_values string",
    )
    write = observations.write_load

    def write_then_deliver(*args):
        write(*args)
        observations.append_raw(late, raw_path)
        monkeypatch.setattr(observations, "write_load", write)

    monkeypatch.setattr(observations, "write_load", write_then_deliver)
    jobs.load(spark, raw_path, rollup_path, models, AS_OF)
    first = pairs(observations.read_rollup(spark, rollup_path), "id", "observe_date")
    left = observations.scan_raw(spark, raw_path).filter("id = 1000000").first()
    assert not left.imported
    # the same load again changes nothing, the next one takes the row and numbers on
    jobs.load(spark, raw_path, rollup_path, models, AS_OF)
    assert pairs(observations.read_rollup(spark, rollup_path), "id", "observe_date") == first
    jobs.load(spark, raw_path, rollup_path, models, AS_OF + timedelta(minutes=1))
    rollup = observations.read_rollup(spark, rollup_path)
    assert rollup.select("id").distinct().count() == rollup.count() > len(first)
    assert observations.scan_raw(spark, raw_path).filter("id = 1000000").first().imported
    values = jobs.read_rejected_values(spark, rollup_path).filter("id = 1000000").collect()
    assert [(r.node_unique_id, r.text) for r in values] == [("a", "bad")]


def test_load_that_dies_anywhere_can_be_repeated(spark, sf_dir, tables, monkeypatch):
    raw_path, rollup_path = tables
    models = dimensions.node_models(spark)
    for name in ("write_load", "overwrite_days"):
        with monkeypatch.context() as patch:
            patch.setattr(observations, name, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                jobs.load(spark, raw_path, rollup_path, models, AS_OF)
    jobs.load(spark, raw_path, rollup_path, models, AS_OF)
    rollup = observations.read_rollup(spark, rollup_path)
    ids = [r.id for r in rollup.select("id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_expire_touches_old_days_only(spark):
    path = scratch_path(spark, "job-raw")
    rows = [(d * 10 + i, datetime(2024, 1, d, 12), "{}", d != 2 or i > 0) for d in range(1, 6) for i in range(3)]
    raw = spark.createDataFrame(rows, "id long, observe_date timestamp, sensor_values string, imported boolean")
    observations.append_by_day(raw, path)

    def files(df):
        return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}

    before = files(observations.scan_raw(spark, path).filter("obs_day >= '2024-01-04'"))
    for _ in range(2):
        jobs.expire(spark, path, datetime(2024, 1, 4, 13), hours=24)
        kept = observations.scan_raw(spark, path)
        assert sorted(r.id for r in kept.collect()) == [20, 40, 41, 42, 50, 51, 52]
        assert files(kept.filter("obs_day >= '2024-01-04'")) == before
    assert {str(r[0]) for r in kept.select("obs_day").distinct().collect()} == {
        "2024-01-02", "2024-01-04", "2024-01-05"}


def test_stored_days_are_sorted(spark, sf_dir):
    path = scratch_path(spark, "job-raw")
    observations.append_raw(testbed.raw(spark, sf_dir), path)
    rows = observations.scan_raw(spark, path).select(
        F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"), "observe_date"
    ).collect()
    by_file = {}
    for r in sorted(rows, key=lambda r: r.n):
        by_file.setdefault(r.f, []).append(r.observe_date)
    assert all(times == sorted(times) for times in by_file.values())


def test_cadence_starts_the_job(spark, tmp_path):
    import time

    runs = []
    query = jobs.on_cadence(spark, runs.append, str(tmp_path / "mark"), lambda: AS_OF)
    for _ in range(200):
        if runs:
            break
        time.sleep(0.1)
    query.stop()
    assert runs[0] == AS_OF


def test_flags_by_row_equal_flags_by_join(spark, sf_dir):
    raw = testbed.raw(spark, sf_dir)
    models = dimensions.node_models(spark)
    minutes = state.closed_averages(raw, models, AS_OF).select("observe_date")
    by_join = state.mark_imported(raw, minutes)
    assert pairs(state.flag_closed(raw, AS_OF), "id", "imported") == pairs(by_join, "id", "imported")


def test_acknowledge_and_backlog(spark, tables):
    raw_path, rollup_path = tables
    models = dimensions.node_models(spark)
    jobs.load(spark, raw_path, rollup_path, models, AS_OF)
    rollup = observations.read_rollup(spark, rollup_path)
    total = rollup.count()
    routed = outbox.route(gates.not_imported(rollup), testbed.delivery_results_for(rollup))
    acked = [r.id for r in outbox.acked_ids(routed).collect()]
    jobs.acknowledge(spark, rollup_path, spark.createDataFrame([(i,) for i in acked], "id long"))
    rollup = observations.read_rollup(spark, rollup_path)
    assert rollup.count() == total
    assert outbox.backlog(rollup).first().pending == total - len(acked)


def test_clean_keeps_what_is_not_expired(spark, tables):
    raw_path, rollup_path = tables
    jobs.load(spark, raw_path, rollup_path, dimensions.node_models(spark), AS_OF)
    raw = observations.scan_raw(spark, raw_path)
    kept_path = scratch_path(spark, "job-kept")
    for _ in range(2):
        jobs.clean(spark, raw_path, kept_path, AS_OF, hours=2)
    kept = observations.scan_raw(spark, kept_path)
    expired = state.expired_rows(raw, AS_OF, hours=2)
    assert expired.count() > 0
    assert kept.count() + expired.count() == raw.count()
    assert pairs(kept, "id") == pairs(state.retain(raw, AS_OF, hours=2), "id")


def test_reprocess_gives_the_same_rollup(spark, tables):
    raw_path, rollup_path = tables
    models = dimensions.node_models(spark)
    columns = ("id", "observe_date", "node_model_id", "node_unique_id", "sensor_value")
    jobs.load(spark, raw_path, rollup_path, models, AS_OF)
    again_raw, again = scratch_path(spark, "job-raw2"), scratch_path(spark, "job-rollup2")
    jobs.reprocess(spark, raw_path, again_raw, again, models, AS_OF)
    assert pairs(observations.read_rollup(spark, again), *columns) == pairs(
        observations.read_rollup(spark, rollup_path), *columns
    )


@pytest.mark.parametrize("null_safe, rows", [
    (False, [("a", 1, 9), ("b", None, 2), ("b", None, 8), ("c", 3, 3)]),
    (True, [("a", 1, 9), ("b", None, 8), ("c", 3, 3)]),
])
def test_upsert(spark, null_safe, rows):
    def table(entries):
        return spark.createDataFrame(
            [(k, str(n) if n else None, v) for k, n, v in entries], "k string, node string, v int"
        )

    old, new = table([("a", 1, 1), ("b", None, 2), ("c", 3, 3)]), table([("a", 1, 9), ("b", None, 8)])
    got = state.upsert(old, new, ["k", "node"], null_safe)
    assert pairs(got, "k", "node", "v") == sorted(
        [(k, str(n) if n else None, v) for k, n, v in rows], key=str
    )


def test_receipts_of_all_three_forms(spark):
    end = datetime(2024, 1, 1, 0, 14)
    empty = spark.createDataFrame([], schemas.RECEIPTS)
    forms = [
        spark.createDataFrame([(end,)], "end_15min timestamp"),
        spark.createDataFrame([(end, "s")], "end_15min timestamp, sensor_name string"),
        spark.createDataFrame([(end, "s", "n")],
                              "end_15min timestamp, sensor_name string, node_unique_id string"),
    ]
    log = empty
    for form in [*forms, *forms]:
        log = state.record_receipts(log, form)
    assert pairs(log, "sensor_name", "node_unique_id") == [("", None), ("s", "n"), ("s", None)]


def test_schema_contract_names_what_is_wrong(spark):
    df = spark.createDataFrame([(1, "x")], "id int, sensor_values string")
    with pytest.raises(ValueError, match="id: int instead of bigint; observe_date: missing"):
        contracts.require(df, schemas.OBSERVATION_RAW)
    assert contracts.probe(df, ["id"]).count() == 0


def test_generators_do_not_depend_on_partitions(spark):
    numbers = generators.row_numbers(spark)
    assert numbers.count() == 50_400
    one = generators.regular_observations(numbers)
    other = generators.regular_observations(numbers.repartition(13))
    assert one.exceptAll(other).isEmpty()
    offsets = one.select(
        (F.unix_micros("observe_date") - F.unix_micros(F.lit("2018-01-01 00:00:00").cast("timestamp"))
         - F.col("id") * 10_000_000).alias("o")
    ).agg(F.min("o"), F.max("o")).first()
    assert -10_000_000 <= offsets[0] < -9_000_000 and 14_000_000 < offsets[1] <= 15_000_000
    keyed = generators.keyed_observations(numbers)
    assert keyed.agg(F.min("calendar_id"), F.max("calendar_id"), F.min("time_id") > 0,
                     F.max("time_id") <= 86_398).first() == (1, 365, True, True)


def test_capture_files(spark, tmp_path):
    for station, count in (("a", 30), ("b", 4)):
        folder = tmp_path / f"station={station}"
        folder.mkdir()
        text = "".join(f"dht11_t:{i}\r\n\r\n" for i in range(count))
        (folder / "capture.txt").write_text(text, newline="")
    df = lines.read_line_files(spark, str(tmp_path))
    rows = df.orderBy("station", "line_no").collect()
    assert [(r.station, r.line) for r in rows] == [
        *[("a", f"dht11_t:{i}") for i in range(30)], *[("b", f"dht11_t:{i}") for i in range(4)],
    ]
