"""Hand-computed rows for the rules that are easy to get wrong."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gaugemill import schemas
from gaugemill.functions import calendar, clock, json_docs, numeric
from gaugemill.operators import (
    batching, gates, keyed, outbox, parsing, readings, rollup, state, windows,
)
from gaugemill.sources import dimensions

NOON = datetime(2024, 1, 1, 12, 0)


def raw_rows(spark, *docs, at=NOON, imported=False):
    rows = [(i, at, doc, imported) for i, doc in enumerate(docs)]
    return spark.createDataFrame(rows, schemas.OBSERVATION_RAW)


def averages(spark, raw, function=rollup.minute_averages):
    rows = function(raw, dimensions.node_models(spark)).collect()
    return {(r.sensor_name, r.node_unique_id): r.sensor_value for r in rows}


def test_payload_with_a_repeated_node(spark):
    raw = raw_rows(
        spark,
        '{"dht11_h": 51.5, "dht11_t": 18.0, "ds18b20_t_uq": [{"cellar": 12.5},'
        ' {"cellar": 12.25}, {"attic": 30.0}]}',
    )
    assert averages(spark, raw) == {
        ("dht11_h", None): Decimal("51.5"), ("dht11_t", None): 18,
        ("ds18b20_t", "cellar"): Decimal("12.375"),
        ("ds18b20_t", "attic"): 30,
    }


def test_payload_with_one_probe(spark):
    raw = raw_rows(spark, '{"dht11_h": 70.2, "dht11_t": 4.6, "ds18b20_t": 4.75}')
    assert averages(spark, raw) == {
        ("dht11_h", None): Decimal("70.2"), ("dht11_t", None): Decimal("4.6"),
        ("ds18b20_t", None): Decimal("4.75"),
    }


def test_bad_neighbours_leave_good_readings_alone(spark):
    raw = raw_rows(
        spark,
        '{"ds18b20_t_uq": [{"a": "bad"}, {"b": 3.5, "c": 1e15}, {"d": {"q": 1}}, {"e": null}]}',
        '{"ds18b20_t_uq": {"f": 3}}', '{"ds18b20_t_uq": [7, {"g": 1}]}', '{"dht11_t": "x"}', "{}",
    )
    assert averages(spark, raw, rollup.minute_avg_nodes) == {("ds18b20_t", "b"): Decimal("3.5")}
    found = sorted(map(tuple, readings.quarantined(raw).collect()), key=str)
    assert [r[1:] for r in found] == [
        ("ds18b20_t", "a", "bad"), ("ds18b20_t", "c", "1.0E15"), ("ds18b20_t", "d", '{"q":1}'),
        ("ds18b20_t", None, '{"f":3}'), ("ds18b20_t", None, '[7,{"g":1}]'), ("dht11_t", None, "x"),
    ]


def test_equal_reading_of_one_node_counts_once_per_observation(spark):
    twice = '{"ds18b20_t_uq": [{"a": 10}, {"a": 10}]}'
    raw = raw_rows(spark, twice, '{"ds18b20_t_uq": [{"a": 40}]}', twice)
    got = averages(spark, raw, rollup.minute_avg_nodes)
    assert got == {("ds18b20_t", "a"): 20}


def test_sentinel_only_minute_gives_no_node_row_but_null_scalars(spark):
    raw = raw_rows(spark, '{"ds18b20_t": -127}')
    assert averages(spark, raw, rollup.minute_avg_nodes) == {}
    assert averages(spark, raw, rollup.minute_avg_scalar) == {
        ("dht11_h", None): None, ("dht11_t", None): None,
    }


def test_null_averages_go_to_quarantine(spark):
    raw = raw_rows(spark, '{"ds18b20_t": 20}')
    load = state.load_closed(raw, dimensions.node_models(spark), datetime(2024, 1, 1, 12, 1))
    assert [(r.node_model_id, r.sensor_value) for r in load.rows.collect()] == [(3, Decimal(20))]
    assert sorted((r.node_model_id, r.reject_reason) for r in load.quarantined.collect()) == [
        (1, "no_value"), (2, "no_value"),
    ]
    assert [r.imported for r in load.raw.collect()] == [True]


def test_out_of_range_average_goes_to_quarantine(spark):
    raw = raw_rows(spark, '{"dht11_t": 1000000, "dht11_h": 1}')
    load = state.load_closed(raw, dimensions.node_models(spark), datetime(2024, 1, 1, 12, 1))
    assert [(r.node_model_id, r.reject_reason) for r in load.quarantined.collect()] == [
        (1, "out_of_range"),
    ]


@pytest.mark.parametrize("doc, expected", [
    ('{"ds18b20_t_uq": []}', []),
    ('{"ds18b20_t_uq": null}', []),
    ('{"ds18b20_t_uq": [{"a": 1, "b": 2}]}', [("a", 1), ("b", 2)]),
    ('{"ds18b20_t_uq": [{"a": 1, "a": 2}]}', [("a", 2)]),
    ('{"ds18b20_t_uq": [null, {"a": 3}]}', [("a", 3)]),
    ('{"ds18b20_t_uq": [{"a": null}]}', [("a", None)]),
])
def test_node_array_shapes(spark, doc, expected):
    rows = readings.node_readings(raw_rows(spark, doc)).collect()
    assert sorted((r.node_unique_id, r.sensor_value) for r in rows) == expected


def test_json_null_counts_as_absent(spark):
    raw = raw_rows(spark, '{"dht11_t": null}', '{"dht11_t": 1}', "{}")
    assert [r.id for r in readings.with_key(raw, "dht11_t").collect()] == [1]
    assert [r.id for r in readings.with_any_sensor(raw).collect()] == [1]


def test_text_numbers_are_read_and_bad_text_does_not_hide_its_neighbours(spark):
    raw = raw_rows(spark, '{"dht11_t": "3.5", "dht11_h": "bad", "ds18b20_t": 2}')
    got = {r.sensor_name: r.sensor_value for r in readings.all_readings(raw).collect()}
    assert got == {"dht11_t": Decimal("3.5"), "dht11_h": None, "ds18b20_t": 2}
    assert [tuple(r) for r in readings.unreadable(raw).collect()] == [(0, "dht11_h", "bad")]


def test_node_readings_equal_the_sum_of_map_sizes(spark):
    raw = raw_rows(
        spark, '{"ds18b20_t_uq": [{"a": 1, "b": 2}, {"c": 3}]}', '{"ds18b20_t_uq": [{"a": 1}]}'
    )
    assert readings.node_readings(raw).count() == 4


# ---- lines ---------------------------------------------------------------------------

def lines_of(spark, *texts, station="s"):
    rows = [(station, i, datetime(2024, 1, 1, 0, 0, i), text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, schemas.LINES)


@pytest.mark.parametrize("line, value, reason", [
    ("dht11_t:3.5", "3.5", None),
    ("dht11_t: 3.5 \t", "3.5", None),
    ("dht11_t:-127.00:extra", "-127", None),
    ("dht11_t:5.", "5", None),
    ("dht11_t:1e2", "100", None),
    ("Address 3", None, parsing.NO_SEPARATOR),
    ("dht11_t:", None, parsing.NOT_NUMERIC),
    ("dht11_t:bad", None, parsing.NOT_NUMERIC),
    ("dht11_t:nan", None, parsing.NOT_NUMERIC),
    ("dht11_t:1_0", None, parsing.NOT_NUMERIC),
    ("dht11_t:1.0d", None, parsing.NOT_NUMERIC),
    ("dht11_t:1e300", None, parsing.OUT_OF_RANGE),
])
def test_line_parsing(spark, line, value, reason):
    row = parsing.parse_lines(lines_of(spark, line)).first()
    assert row.reject_reason == reason
    assert row.value == (Decimal(value) if value is not None else None)


def test_good_and_quarantined_lines_are_all_lines(spark):
    lines = lines_of(spark, "a:1", "b", "c:x", "ds18b20_t_N1:2", "\r", "")
    counted = parsing.drop_blank(lines)
    parsed = parsing.parse_lines(counted)
    assert counted.count() == 4
    assert parsing.good_lines(parsed).count() + parsing.quarantine(parsed).count() == 4


def test_broken_encoding_is_quarantined(spark):
    lines = lines_of(spark, "x").withColumn(
        "line", F.concat(F.lit("dht11_t:1"), F.expr("cast(X'FF' as string)"))
    )
    assert parsing.parse_lines(lines).first().reject_reason == parsing.BAD_ENCODING


def test_assembled_observation(spark):
    lines = lines_of(
        spark, "dht11_t:1.5", "dht11_t:2", "Address 0", "ds18b20_t_A:3.25", "ds18b20_t_A:3.25",
        "ds18b20_t_B:4", "dht11_h:9", "dht11_h:10",
    )
    row, = batching.assemble(batching.count_windows(lines, 7)).collect()
    assert row.batch_no == 0
    assert row.observe_date == datetime(2024, 1, 1, 0, 0, 6)
    # last value of a key wins, equal node lines count once, line 8 waits
    assert row.sensor_values == (
        '{"dht11_t":2.0,"dht11_h":9.0,"ds18b20_t_uq":[{"A":3.25},{"B":4.0}]}'
    )


def test_keys_are_escaped_and_a_batch_without_readings_is_empty(spark):
    rows = batching.assemble(
        batching.count_windows(lines_of(spark, 'k"\\:1', "x", "y", "z"), 2)
    ).orderBy("batch_no").collect()
    assert [r.sensor_values for r in rows] == ['{"k\\"\\\\":1.0}', "{}"]


# ---- clock and calendar ----------------------------------------------------------------

def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_quarter_hour_label_and_end(spark):
    second = F.lit(12 * 3600 + 7 * 60)
    assert one(spark, clock.quarter_label(second)) == "12:00 – 12:14"
    assert one(spark, clock.quarter_end(F.lit(date(2024, 1, 1)), second)) == datetime(2024, 1, 1, 12, 14)


def test_iso_year_turn(spark):
    day = F.lit(date(2018, 12, 31))
    assert one(spark, calendar.iso_year_week(day)) == "2019/01"
    assert one(spark, calendar.calendar_columns(day)["cwstart"]) == date(2018, 12, 31)


def test_daylight_saving_zone(spark):
    local = F.lit("2024-07-01 12:14:00").cast("timestamp_ntz")
    instant = clock.local_to_instant(local, F.lit("America/Denver")).cast("string")
    assert one(spark, instant) == "2024-07-01 18:14:00"


def test_fahrenheit(spark):
    assert one(spark, numeric.to_fahrenheit(F.lit(100))) == Decimal("212.00")
    assert one(spark, numeric.to_fahrenheit(F.lit(None).cast("double"))) is None


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([("a", "0.005"), ("b", "-0.005")], "k string, v string")
    rows = df.groupBy("k").agg(
        numeric.rounded_mean(F.col("v").cast("decimal(18,6)"), 2).alias("m")
    ).orderBy("k").collect()
    assert [r.m for r in rows] == [Decimal("0.01"), Decimal("-0.01")]


def test_row_document_keeps_null_fields(spark):
    doc = json_docs.row_json(F.lit(1).alias("id"), F.lit(None).cast("string").alias("node"))
    assert one(spark, doc) == '{"id":1,"node":null}'


def test_dimensions(spark):
    dates = dimensions.calendar_dimension(spark)
    assert dates.count() == 28_401
    assert dates.agg(F.min("datum"), F.max("calendar_id")).first() == (date(2018, 1, 1), 28_401)
    times = dimensions.time_dimension(spark)
    assert times.count() == 86_400
    assert times.filter("time_id = 86400").first().timeofday == "23:59:59"
    parts = times.filter("second = 0").groupBy("daytimename").count().collect()
    assert {r["daytimename"]: r["count"] for r in parts} == {
        "Early Morning": 210, "Morning": 210, "Afternoon": 360, "Evening": 270, "Night": 390,
    }
    assert times.filter("daynight = 'Day'").count() == 13 * 3600


def keyed_rows(spark, *entries):
    """(local timestamp, zone, document) rows."""
    rows = []
    for i, (when, zone, doc) in enumerate(entries):
        day = (when.date() - date(2018, 1, 1)).days + 1
        second = when.hour * 3600 + when.minute * 60 + when.second
        rows.append((i, day, second + 1, zone, doc, False))
    return spark.createDataFrame(rows, schemas.OBSERVATION_V1)


@pytest.mark.parametrize("wrap, expected", [(False, [1]), (True, [0, 1, 3])])
def test_guard_at_midnight(spark, wrap, expected):
    rows = keyed_rows(
        spark,
        (datetime(2024, 1, 1, 23, 58, 10), "UTC", "{}"),   # minute still open
        (datetime(2024, 1, 1, 23, 55, 59), "UTC", "{}"),   # closed
        (datetime(2024, 1, 1, 23, 57, 0), "UTC", "{}"),    # inside the guard
        (datetime(2024, 1, 2, 0, 0, 0), "UTC", "{}"),      # future date
    )
    kept = gates.eligible(rows, datetime(2024, 1, 1, 23, 58, 40), wrap).collect()
    assert sorted(r.observation_id for r in kept) == expected


def test_guard_uses_the_rows_own_zone(spark):
    rows = keyed_rows(
        spark,
        (datetime(2024, 1, 1, 5, 57, 0), "UTC", "{}"),
        (datetime(2024, 1, 1, 5, 57, 0), "America/Denver", "{}"),
        (datetime(2024, 1, 1, 6, 57, 0), "Europe/Berlin", "{}"),
        (datetime(2023, 12, 31, 23, 59, 0), "UTC", "{}"),
    )
    kept = gates.eligible(rows, datetime(2024, 1, 1, 6, 0, 30)).collect()
    assert sorted(r.observation_id for r in kept) == [0, 2, 3]


def test_equal_readings_of_one_second_count_once(spark):
    at = datetime(2024, 1, 1, 1, 2, 3)
    rows = keyed_rows(
        spark,
        (at, "UTC", '{"dht11_t": 10}'), (at, "UTC", '{"dht11_t": 10}'),
        (at.replace(second=4), "UTC", '{"dht11_t": 40}'),
    )
    got = {
        r.sensor_name: r.sensor_value
        for r in keyed.minute_rollup(rows, datetime(2024, 1, 2)).collect()
    }
    assert got == {"dht11_t": 25, "dht11_h": None}


def test_quarter_mean_is_unweighted_and_a_missing_node_equals_an_empty_one(spark):
    fact = spark.createDataFrame(
        [(1, 1, "UTC", "dht11_t", None, Decimal(10)), (1, 61, "UTC", "dht11_t", None, Decimal(20)),
         (1, 901, "UTC", "dht11_t", "", Decimal(5))],
        schemas.OBSERVATION_MINUTE,
    )
    receipts = spark.createDataFrame(
        [(datetime(2018, 1, 1, 0, 14), "dht11_t", ""), (datetime(2018, 1, 1, 0, 14), "dht11_t", ""),
         (datetime(2018, 1, 1, 0, 29), "dht11_t", None)],
        schemas.RECEIPTS,
    )
    rows = windows.quarter_means_by_node(fact, receipts).orderBy("end_15min").collect()
    assert [(r.sensor_value, r.submitted_to_api) for r in rows] == [(15, 1), (5, 1)]


def test_duplicate_receipts_do_not_inflate_counts(spark):
    rows = keyed_rows(spark, (datetime(2024, 1, 1, 0, 1, 0), "UTC", '{"dht11_t": 1}'))
    end = datetime(2024, 1, 1, 0, 14)
    receipts = spark.createDataFrame([(end, "", None), (end, "x", None)], schemas.RECEIPTS)
    row, = windows.quarter_summary_flagged(rows, receipts).collect()
    assert (row.observation_cnt, row.submitted_to_api) == (1, 1)


# ---- delivery ---------------------------------------------------------------------------

def test_a_refused_credential_stops_the_run(spark):
    pending = spark.createDataFrame(
        [(i, datetime(2024, 1, 1, 0, 10 - i)) for i in range(1, 6)], "id long, observe_date timestamp"
    )
    replies = spark.createDataFrame(
        [(1, 201), (2, 404), (3, 401), (4, 201), (5, 500)], schemas.DELIVERY_RESULTS
    )
    stopped = {r.id: r.outcome for r in outbox.route(pending, replies, stop_at_fatal=True).collect()}
    assert stopped == {1: "acked", 2: "retry", 3: "fatal", 4: "pending", 5: "pending"}
    free = {r.id: r.outcome for r in outbox.route(pending, replies).collect()}
    assert free[4] == "acked"


def test_rows_without_a_reply_stay_pending(spark):
    pending = spark.createDataFrame([(1, NOON)], "id long, observe_date timestamp")
    replies = spark.createDataFrame([], schemas.DELIVERY_RESULTS)
    assert [r.outcome for r in outbox.route(pending, replies, True).collect()] == ["pending"]
