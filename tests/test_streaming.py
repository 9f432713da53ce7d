"""Streams equal their batch counterparts, and survive replays and restarts."""

import pytest
from pyspark.sql import functions as F

from gaugemill import schemas
from gaugemill.operators import batching
from gaugemill.session import scratch_path
from gaugemill.sources import dimensions, lines as sources, testbed
from gaugemill.streaming import count_window, late, runner, tumbling


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_count_window_over_several_micro_batches(spark, sf_dir):
    lines = testbed.lines(spark, sf_dir)
    cuts = [0, 3, 250, 251, 700, 10**9]  # one delivery is smaller than a batch
    inbox, mark = scratch_path(spark, "in"), scratch_path(spark, "mark")
    out, memory = scratch_path(spark, "out"), scratch_path(spark, "state")
    for low, high in zip(cuts, cuts[1:]):
        part = lines.filter(F.col("line_no").between(low, high - 1))
        part.write.mode("append").parquet(inbox)
        # a new object each time: nothing is kept in memory between runs
        step = count_window.CountWindow(spark, 7, out, memory)
        stream = spark.readStream.schema(schemas.LINES).parquet(inbox)
        runner.drain(runner.per_batch(stream, step, mark))
    got = count_window.read_observations(spark, out)
    want = batching.assemble(batching.count_windows(lines, 7))
    columns = ("station", "batch_no", "observe_date", "sensor_values")
    assert rows(got, *columns) == rows(want, *columns)


def test_replayed_micro_batch_changes_nothing(spark, sf_dir):
    lines = testbed.lines(spark, sf_dir)
    out, memory = scratch_path(spark, "out"), scratch_path(spark, "state")
    step = count_window.CountWindow(spark, 7, out, memory)
    first, second = lines.filter("line_no < 500"), lines.filter("line_no >= 500")
    step(first, 0)
    step(second, 1)
    before = rows(count_window.read_observations(spark, out), "station", "batch_no", "sensor_values")
    step(second, 1)
    after = rows(count_window.read_observations(spark, out), "station", "batch_no", "sensor_values")
    assert before == after


def test_stations_that_pause_keep_their_waiting_lines(spark):
    out, memory = scratch_path(spark, "out"), scratch_path(spark, "state")
    step = count_window.CountWindow(spark, 3, out, memory)

    def delivery(*entries):
        return spark.createDataFrame(
            [(s, n, None, f"k{n}:1") for s, n in entries], schemas.LINES
        )

    step(delivery(("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 3), ("b", 4)), 0)
    step(delivery(("b", 5)), 1)
    step(delivery(("a", 3), ("b", 6)), 2)
    got = rows(count_window.read_observations(spark, out), "station", "batch_no", "sensor_values")
    assert got == [
        ("a", 0, '{"k1":1.0,"k2":1.0,"k3":1.0}'),
        ("b", 0, '{"k1":1.0,"k2":1.0,"k3":1.0}'),
        ("b", 1, '{"k4":1.0,"k5":1.0,"k6":1.0}'),
    ]


def test_waiting_lines_keep_their_order_when_numbers_restart(spark):
    out, memory = scratch_path(spark, "out"), scratch_path(spark, "state")
    step = count_window.CountWindow(spark, 3, out, memory)
    for batch, (number, line) in enumerate([(5, "x:1"), (0, "x:2"), (3, "y:3")]):
        step(spark.createDataFrame([("s", number, None, line)], schemas.LINES), batch)
    got = rows(count_window.read_observations(spark, out), "sensor_values")
    assert got == [('{"x":2.0,"y":3.0}',)]


def test_files_of_one_station_follow_each_other(spark, tmp_path):
    import os

    folder = tmp_path / "in" / "station=s"
    folder.mkdir(parents=True)
    for age, (name, lines_) in enumerate([("b", "k1:1\n\nk2:1\n"), ("a", "k3:1\nk4:1\n")]):
        (folder / name).write_text(lines_)
        os.utime(folder / name, (1_700_000_000 + age, 1_700_000_000 + age))
    got = sorted(map(tuple, sources.read_line_files(spark, str(tmp_path / "in")).select("line_no", "line").collect()))
    assert got == [(1, "k1:1"), (2, "k2:1"), (3, "k3:1"), (4, "k4:1")]
    out, memory, mark = (scratch_path(spark, x) for x in ("out", "state", "mark"))
    stream = sources.stream_line_files(spark, str(tmp_path / "in"))
    runner.drain(runner.per_batch(stream, count_window.CountWindow(spark, 3, out, memory), mark))
    assert rows(count_window.read_observations(spark, out), "sensor_values") == [('{"k1":1.0,"k2":1.0,"k3":1.0}',)]


def test_late_rows_correct_closed_minutes(spark):
    def delivery(*entries):
        return spark.createDataFrame(
            [(i, t, f'{{"dht11_t": {v}}}', False) for i, (t, v) in enumerate(entries)],
            "id long, observe_date string, sensor_values string, imported boolean",
        ).withColumn("observe_date", F.concat(F.lit("2024-01-01 00:"), "observe_date").cast("timestamp"))

    path = scratch_path(spark, "log")
    step = late.PartialLog(path)
    step(delivery(("02:05", 10), ("09:30", 1)), 0)
    step(delivery(("02:40", 20)), 1)  # behind the watermark
    got = tumbling.closed_minutes(late.read_log(spark, path), dimensions.node_models(spark))
    values = {r.observe_date.minute: r.sensor_value for r in got.filter("sensor_name = 'dht11_t'").collect()}
    assert values == {2: 15}  # minute 9 is still open


@pytest.mark.parametrize("policy, expected", [
    (late.append_policy, [15, 60]), (late.overwrite_policy, [60]), (late.exact_policy, [30]),
])
def test_late_reading(spark, policy, expected):
    def delivery(*values):
        return spark.createDataFrame(
            [(i, None, f'{{"dht11_t": {v}}}', False) for i, v in enumerate(values)],
            "id long, observe_date string, sensor_values string, imported boolean",
        ).withColumn("observe_date", F.lit("2024-01-01 12:00:10").cast("timestamp"))

    path = scratch_path(spark, "log")
    step = late.PartialLog(path)
    step(delivery(10, 20), 0)
    step(delivery(60), 1)
    step(delivery(60), 1)  # replay
    got = policy(late.read_log(spark, path)).collect()
    assert sorted(r.sensor_value for r in got) == expected
