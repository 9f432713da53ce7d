"""The same results as plain SQL over the given tables, for checking the queries.

Means are computed from exact integer sums (millionths), because an average of
decimals is a binary float in the checking engine.
"""

from __future__ import annotations

from gaugemill.constants import SYNTHETIC_PAYLOAD

AS_OF = "TIMESTAMP '2024-01-01 06:00:30'"
OPEN_MINUTE = "TIMESTAMP '2024-01-01 06:00:00'"
KEYED_AS_OF = "TIMESTAMP '2024-01-01 14:00:30'"


# ---- building blocks ------------------------------------------------------------------

def micro(text: str) -> str:
    """Decimal text as an integer number of millionths."""
    return f"CAST(CAST({text} AS DECIMAL(18,6)) * 1000000 AS BIGINT)"


def mean(digits: int, value: str = "v") -> str:
    """Mean of millionths, rounded half away from zero, as a double."""
    unit = 10 ** (6 - digits)
    total, count = f"CAST(SUM({value}) AS HUGEINT)", f"CAST(COUNT({value}) AS HUGEINT)"
    return (
        f"CASE WHEN COUNT({value}) > 0 THEN CAST(CASE WHEN SUM({value}) < 0 THEN -1 ELSE 1 END"
        f" * ((2 * abs({total}) + {count} * {unit}) // (2 * {count} * {unit})) AS DOUBLE)"
        f" / {10 ** digits} END"
    )


def shown(value: str) -> str:
    return f"CAST({value} AS DOUBLE) / 1000000"


def with_(*names: str) -> str:
    """WITH clause holding the named blocks and everything they build on."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for other in NEEDS.get(name, ()):
            visit(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in needed) + "\n"


_DOC = """CASE event_type
    WHEN 'signup' THEN '{"dht11_t": ' || amount || '}'
    WHEN 'purchase' THEN '{"dht11_h": ' || amount || '}'
    WHEN 'view' THEN '{"ds18b20_t": ' || amount || '}'
    WHEN 'click' THEN '{"ds18b20_t_uq": [{"N' || (user_id % 5) || '": ' || amount
        || '},{"N' || (user_id % 5) || '": ' || amount || '},{"X": -127}]}'
    ELSE '{"ds18b20_t": -127}' END"""

_QUARTER_END = (
    "date_trunc('hour', {ts}) + to_minutes(CAST(minute({ts}) // 15 * 15 + 14 AS BIGINT))"
)

BLOCKS = {
    "ev": """SELECT *, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS amount,
        make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60) AS moment
        FROM events""",
    "lines": """SELECT 'st' || (user_id % 5) AS station, event_id AS line_no, moment AS arrived_at,
        CASE event_type
            WHEN 'signup' THEN 'dht11_t:' || amount
            WHEN 'purchase' THEN 'dht11_h:' || amount
            WHEN 'view' THEN 'ds18b20_t:' || amount
            WHEN 'click' THEN 'ds18b20_t_N' || (user_id % 5) || ':' || amount
            ELSE CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'Address 3'
                WHEN 2 THEN 'dht11_t:bad' ELSE 'dht11_t:-127.00:extra' END END AS line
        FROM ev""",
    "parsed": """SELECT station, line_no, arrived_at, line, key, raw_value,
        CASE WHEN starts_with(key, 'ds18b20_t_') THEN substr(key, 11) END AS node_unique_id,
        CASE WHEN raw_value IS NULL THEN 'no_separator'
             WHEN NOT regexp_full_match(raw_value, '[+-]?[0-9]+(\\.[0-9]*)?') THEN 'not_numeric'
             END AS reject_reason,
        CASE WHEN regexp_full_match(raw_value, '[+-]?[0-9]+(\\.[0-9]*)?')
             THEN CAST(raw_value AS DOUBLE) END AS value
        FROM (SELECT *, string_split(line, ':')[1] AS key,
                     CASE WHEN contains(line, ':') THEN string_split(line, ':')[2] END AS raw_value
              FROM lines WHERE line <> '')""",
    "batches": """SELECT * FROM (
            SELECT *, (row_number() OVER (PARTITION BY station ORDER BY line_no) - 1) // 7 AS batch_no,
                   count(*) OVER (PARTITION BY station) // 7 AS full_batches
            FROM parsed)
        WHERE batch_no < full_batches""",
    "assembled": """SELECT station, CAST(batch_no AS BIGINT) AS batch_no,
            max(arrived_at) AS observe_date,
            '{' || concat_ws(',',
                string_agg(CASE WHEN node_unique_id IS NULL AND value IS NOT NULL AND last_of_key = 1
                    THEN '"' || key || '":' || CAST(value AS VARCHAR) END, ',' ORDER BY line_no),
                CASE WHEN count(CASE WHEN node_unique_id IS NOT NULL THEN 1 END) > 0
                    THEN '"ds18b20_t_uq":[' || string_agg(
                        CASE WHEN node_unique_id IS NOT NULL AND last_of_line = 1
                        THEN '{"' || node_unique_id || '":' || CAST(value AS VARCHAR) || '}' END,
                        ',' ORDER BY line_no) || ']' END) || '}' AS sensor_values
        FROM (SELECT *,
                row_number() OVER (PARTITION BY station, batch_no, key, value IS NULL
                    ORDER BY line_no DESC) AS last_of_key,
                row_number() OVER (PARTITION BY station, batch_no, line
                    ORDER BY line_no DESC) AS last_of_line
              FROM batches)
        GROUP BY station, batch_no""",
    "raw": f"""SELECT event_id AS id, moment AS observe_date, {_DOC} AS sensor_values,
        event_id % 7 = 0 AS imported FROM ev""",
    "scalar": f"""SELECT id, observe_date, imported, 'dht11_h' AS sensor_name,
            {micro("json_extract_string(sensor_values, '$.dht11_h')")} AS v FROM raw
        UNION ALL SELECT id, observe_date, imported, 'dht11_t',
            {micro("json_extract_string(sensor_values, '$.dht11_t')")} FROM raw""",
    "elements": """SELECT id, observe_date, imported,
            unnest(CAST(json_extract(sensor_values, '$.ds18b20_t_uq') AS JSON[])) AS element
        FROM raw WHERE json_extract_string(sensor_values, '$.ds18b20_t_uq') IS NOT NULL""",
    "node_rows": f"""SELECT id, observe_date, imported, node AS node_unique_id,
            {micro("json_extract_string(element, '$.' || node)")} AS v
        FROM (SELECT *, unnest(json_keys(element)) AS node FROM elements)""",
    "probe": f"""SELECT DISTINCT * FROM (
            SELECT id, observe_date, imported, CAST(NULL AS VARCHAR) AS node_unique_id,
                {micro("json_extract_string(sensor_values, '$.ds18b20_t')")} AS v FROM raw
            UNION ALL SELECT id, observe_date, imported, node_unique_id, v FROM node_rows)
        WHERE v <> -127000000""",
    "readings": """SELECT id, observe_date, imported, sensor_name,
            CAST(NULL AS VARCHAR) AS node_unique_id, v FROM scalar
        UNION ALL SELECT id, observe_date, imported, 'ds18b20_t', node_unique_id, v FROM probe""",
    "models": """SELECT * FROM (VALUES (1, 'DHT-11 (T)', 'dht11_t', 1, 1, 'Temperature', 'C'),
            (2, 'DHT-11 (H)', 'dht11_h', 2, 2, 'Humidity', '%'),
            (3, 'DS18B20', 'ds18b20_t', 1, 1, 'Temperature', 'C'))
        AS m(id, name, column_name, value_type_id, value_unit_id, type_name, unit_name)""",
    "minutes": f"""SELECT date_trunc('minute', r.observe_date) AS observe_date,
            m.id AS node_model_id, r.sensor_name, r.node_unique_id, r.imported,
            {mean(6)} AS sensor_value
        FROM readings r JOIN models m ON m.column_name = r.sensor_name GROUP BY ALL""",
    "loadable": f"""SELECT observe_date, node_model_id, sensor_value, node_unique_id FROM minutes
        WHERE NOT imported AND observe_date < {OPEN_MINUTE}""",
    "loaded": "SELECT * FROM loadable WHERE sensor_value IS NOT NULL",
    "rollup": """SELECT *, id % 3 = 0 AS imported FROM (
        SELECT row_number() OVER (ORDER BY observe_date,
                substr(md5(coalesce(node_unique_id, '')), 1, 2), node_model_id,
                coalesce(node_unique_id, '')) AS id,
            observe_date, node_model_id, sensor_value, node_unique_id FROM loaded)""",
    "named": """SELECT r.id, observe_date, m.column_name AS sensor_name, sensor_value,
            node_unique_id, imported
        FROM rollup r JOIN models m ON m.id = r.node_model_id""",
    "keyed": f"""SELECT unnest(CASE WHEN event_type = 'signup'
                THEN [event_id, -event_id - 1] ELSE [event_id] END) AS observation_id,
            CAST(date_diff('day', DATE '2018-01-01', CAST(moment AS DATE)) + 1 AS INTEGER) AS calendar_id,
            CAST(hour(moment) * 3600 + minute(moment) * 60 + second(moment) + 1 AS INTEGER) AS time_id,
            CASE user_id % 3 WHEN 0 THEN 'UTC' WHEN 1 THEN 'America/Denver'
                ELSE 'Europe/Berlin' END AS timezone,
            {_DOC} AS sensor_values, event_id % 7 = 0 AS imported FROM ev""",
    "keyed_at": """SELECT *, DATE '2018-01-01' + (calendar_id - 1) AS datum,
            CAST(DATE '2018-01-01' + (calendar_id - 1) AS TIMESTAMP)
                + to_seconds(CAST(time_id - 1 AS BIGINT)) AS tstamp
        FROM keyed""",
    "gated": f"""SELECT *, (datum < CAST(local_now AS DATE) OR (datum = CAST(local_now AS DATE)
            AND (time_id - 1) // 60 + 2 < hour(local_now) * 60 + minute(local_now))) AS closed
        FROM (SELECT *, timezone(timezone, timezone('UTC', {KEYED_AS_OF})) AS local_now
              FROM keyed_at)""",
    "keyed_probe": f"""SELECT observation_id, calendar_id, time_id, timezone, imported, closed,
            'ds18b20_t' AS sensor_name, node AS node_unique_id,
            {micro("json_extract_string(element, '$.' || node)")} AS v
        FROM (SELECT *, unnest(json_keys(element)) AS node FROM (
            SELECT *, unnest(CAST(json_extract(sensor_values, '$.ds18b20_t_uq') AS JSON[])) AS element
            FROM gated WHERE json_extract_string(sensor_values, '$.ds18b20_t_uq') IS NOT NULL))
        UNION ALL
        SELECT observation_id, calendar_id, time_id, timezone, imported, closed, 'ds18b20_t', NULL,
            {micro("json_extract_string(sensor_values, '$.ds18b20_t')")} FROM gated""",
    "keyed_readings": f"""SELECT observation_id, calendar_id, time_id, timezone, imported, closed,
            'dht11_h' AS sensor_name, CAST(NULL AS VARCHAR) AS node_unique_id,
            {micro("json_extract_string(sensor_values, '$.dht11_h')")} AS v FROM gated
        UNION ALL
        SELECT observation_id, calendar_id, time_id, timezone, imported, closed, 'dht11_t', NULL,
            {micro("json_extract_string(sensor_values, '$.dht11_t')")} FROM gated
        UNION ALL SELECT * FROM keyed_probe WHERE v <> -127000000""",
    "minute_fact": f"""SELECT calendar_id, time_id, timezone, sensor_name, node_unique_id,
            {mean(2)} AS sensor_value
        FROM (SELECT DISTINCT calendar_id, time_id AS second_id,
                  CAST((time_id - 1) // 60 * 60 + 1 AS INTEGER) AS time_id,
                  timezone, sensor_name, node_unique_id, v
              FROM keyed_readings WHERE closed AND NOT imported)
        GROUP BY ALL""",
    "keyed_wide": f"""SELECT *, {micro("t")} AS tv, {micro("h")} AS hv, {micro("d")} AS dv
        FROM (SELECT *, hour(tstamp) AS hh, minute(tstamp) AS mm,
                json_extract_string(sensor_values, '$.dht11_t') AS t,
                json_extract_string(sensor_values, '$.dht11_h') AS h,
                json_extract_string(sensor_values, '$.ds18b20_t') AS d,
                strftime(date_trunc('hour', tstamp) + to_minutes(CAST(minute(tstamp) // 15 * 15 AS BIGINT)), '%H:%M')
                    || ' – ' || strftime({_QUARTER_END.format(ts='tstamp')}, '%H:%M') AS quarterhour,
                timezone(timezone, {_QUARTER_END.format(ts='tstamp')}) AS end_tz
              FROM keyed_at)
        WHERE t <> '' OR h <> '' OR d <> ''""",
    "zoned": f"""SELECT datum, CAST(hh AS INTEGER) AS hour, quarterhour,
            CAST(count(*) AS INTEGER) AS observation_cnt,
            {mean(1, 'tv')} AS dht11_t, {mean(0, 'hv')} AS dht11_h, {mean(1, 'dv')} AS ds18b20_t,
            timezone('UTC', end_tz) AS end_15min, timezone
        FROM keyed_wide GROUP BY datum, hh, quarterhour, end_tz, timezone""",
    "receipts": f"""SELECT end_15min, sensor_name,
            CASE WHEN node_unique_id IS NULL AND sensor_name = 'dht11_t' THEN ''
                ELSE node_unique_id END AS node_unique_id
        FROM (SELECT DISTINCT {_QUARTER_END.format(ts='observe_date')} AS end_15min,
                sensor_name, node_unique_id FROM readings WHERE v IS NOT NULL)
        WHERE end_15min < TIMESTAMP '2024-01-01 03:00:00'
            OR (sensor_name = 'dht11_h' AND end_15min < TIMESTAMP '2024-01-01 06:00:00')""",
    "fact_quarters": """SELECT *, CAST((time_id - 1) // 3600 AS INTEGER) AS hour,
            DATE '2018-01-01' + (calendar_id - 1) AS datum,
            CAST(DATE '2018-01-01' + (calendar_id - 1) AS TIMESTAMP)
                + to_minutes(CAST((time_id - 1) // 900 * 15 AS BIGINT)) AS quarter_start
        FROM minute_fact""",
    "long_sensor": f"""SELECT datum, hour, strftime(quarter_start, '%H:%M') || ' – '
                || strftime(quarter_start + to_minutes(14), '%H:%M') AS quarterhour,
            sensor_name, timezone, quarter_start + to_minutes(14) AS end_15min,
            {mean(2, 'CAST(round(sensor_value * 1000000) AS BIGINT)')} AS sensor_value
        FROM fact_quarters GROUP BY datum, hour, quarter_start, sensor_name, timezone""",
    "long_node": f"""SELECT datum, hour, strftime(quarter_start, '%H:%M') || ' – '
                || strftime(quarter_start + to_minutes(14), '%H:%M') AS quarterhour,
            sensor_name, node_unique_id, timezone, quarter_start + to_minutes(14) AS end_15min,
            {mean(2, 'CAST(round(sensor_value * 1000000) AS BIGINT)')} AS sensor_value
        FROM fact_quarters
        GROUP BY datum, hour, quarter_start, sensor_name, node_unique_id, timezone""",
    "long_sensor_flagged": """SELECT l.*, CAST(CASE WHEN r.end_15min IS NOT NULL THEN 1 ELSE 0 END
            AS INTEGER) AS submitted_to_api
        FROM long_sensor l LEFT JOIN (SELECT DISTINCT end_15min, sensor_name FROM receipts) r
            ON l.end_15min = r.end_15min AND l.sensor_name = r.sensor_name""",
    "long_node_flagged": """SELECT l.*, CAST(CASE WHEN r.end_15min IS NOT NULL THEN 1 ELSE 0 END
            AS INTEGER) AS submitted_to_api
        FROM long_node l LEFT JOIN (
            SELECT DISTINCT end_15min, sensor_name, coalesce(node_unique_id, '') AS node FROM receipts) r
            ON l.end_15min = r.end_15min AND l.sensor_name = r.sensor_name
            AND coalesce(l.node_unique_id, '') = r.node""",
    "zoned_flagged": """SELECT z.*, CAST(CASE WHEN r.end_15min IS NOT NULL THEN 1 ELSE 0 END
            AS INTEGER) AS submitted_to_api
        FROM zoned z LEFT JOIN (SELECT DISTINCT end_15min FROM receipts) r
            ON z.end_15min = r.end_15min""",
    "partials": """SELECT date_trunc('minute', observe_date) AS observe_date, sensor_name,
            node_unique_id, CASE WHEN id % 13 = 0 THEN 1 ELSE 0 END AS micro_batch, v
        FROM readings WHERE v IS NOT NULL""",
    "routed": """SELECT id, observe_date, CASE WHEN id % 10 <= 6 THEN 'acked' WHEN id % 10 = 7 THEN 'retry'
            WHEN id % 10 = 8 THEN 'pending' ELSE 'fatal' END AS outcome
        FROM rollup WHERE NOT imported""",
    "watermark": """SELECT date_trunc('millisecond', max(observe_date)) AS seen FROM raw""",
}

NEEDS = {
    "lines": ["ev"], "parsed": ["lines"], "batches": ["parsed"], "assembled": ["batches"],
    "raw": ["ev"], "scalar": ["raw"], "elements": ["raw"], "node_rows": ["elements"],
    "probe": ["node_rows"], "readings": ["scalar", "probe"], "minutes": ["readings", "models"],
    "loadable": ["minutes"], "loaded": ["loadable"], "rollup": ["loaded"],
    "named": ["rollup", "models"], "keyed": ["ev"], "keyed_at": ["keyed"], "gated": ["keyed_at"],
    "keyed_probe": ["gated"], "keyed_readings": ["keyed_probe"], "minute_fact": ["keyed_readings"],
    "keyed_wide": ["keyed_at"], "zoned": ["keyed_wide"], "receipts": ["readings"],
    "fact_quarters": ["minute_fact"], "long_sensor": ["fact_quarters"],
    "long_node": ["fact_quarters"], "long_sensor_flagged": ["long_sensor", "receipts"],
    "long_node_flagged": ["long_node", "receipts"], "zoned_flagged": ["zoned", "receipts"],
    "partials": ["readings"], "routed": ["rollup"], "watermark": ["raw"],
}


def calendar_sql(day: str) -> str:
    """Date attributes of a DATE expression."""
    return f"""CAST(year({day}) AS INTEGER) AS year, CAST(month({day}) AS INTEGER) AS month,
        monthname({day}) AS monthname, CAST(day({day}) AS INTEGER) AS day,
        CAST(dayofyear({day}) AS INTEGER) AS dayofyear, dayname({day}) AS weekdayname,
        CAST(weekofyear({day}) AS INTEGER) AS calendarweek,
        strftime({day}, '%d/%m/%Y') AS formatteddate,
        'Q' || quarter({day}) AS quartal, year({day}) || '/Q' || quarter({day}) AS yearquartal,
        strftime({day}, '%Y/%m') AS yearmonth, strftime({day}, '%G/%V') AS yearcalendarweek,
        CASE WHEN isodow({day}) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS weekend,
        CAST(date_trunc('week', {day}) AS DATE) AS cwstart,
        CAST(date_trunc('week', {day}) AS DATE) + 6 AS cwend,
        CAST(date_trunc('month', {day}) AS DATE) AS monthstart,
        last_day({day}) AS monthend"""


def day_part_sql(ts: str) -> str:
    hhmm = f"strftime({ts}, '%H:%M')"
    return f"""CASE WHEN {hhmm} BETWEEN '05:00' AND '08:29' THEN 'Early Morning'
        WHEN {hhmm} BETWEEN '08:30' AND '11:59' THEN 'Morning'
        WHEN {hhmm} BETWEEN '12:00' AND '17:59' THEN 'Afternoon'
        WHEN {hhmm} BETWEEN '18:00' AND '22:29' THEN 'Evening' ELSE 'Night' END AS daytimename,
        CASE WHEN {hhmm} BETWEEN '07:00' AND '19:59' THEN 'Day' ELSE 'Night' END AS daynight"""


def quarter_label_sql(ts: str) -> str:
    start = f"(date_trunc('hour', {ts}) + to_minutes(CAST(minute({ts}) // 15 * 15 AS BIGINT)))"
    return f"strftime({start}, '%H:%M') || ' – ' || strftime({start} + to_minutes(14), '%H:%M')"


def draw(number: str, name: str) -> str:
    """The generator's uniform draw in millionths."""
    return f"(CAST('0x' || substr(md5('42:{name}:' || ({number})), 1, 13) AS BIGINT) % 1000000)"


def cents(operator: str) -> str:
    """Whole units or remaining hundredths of a non-negative mean, rounded half up."""
    return (
        f"((CAST(round(sensor_value * 1000000) AS BIGINT) + 5000) // 10000 {operator} 100)"
    )


def feed_doc(extra: str = "") -> str:
    return f"""'{{"id":' || id || ',"observe_date":"' || strftime(observe_date, '%Y-%m-%dT%H:%M:%S')
        || '+00:00","sensor_name":"' || sensor_name || '","node_unique_id":'
        || coalesce('"' || node_unique_id || '"', 'null') || ',"sensor_value":'
        || {cents('//')} || '.' || lpad(CAST({cents('%')} AS VARCHAR), 2, '0') || '{extra}}}'"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # scans, sources, sinks
    sql["scan_lines"] = with_("lines") + (
        "SELECT station, line_no, arrived_at, line FROM lines WHERE line <> ''"
    )
    sql["scan_raw_observations"] = with_("raw") + "SELECT id, observe_date, sensor_values FROM raw"
    sql["append_raw_observations"] = with_("raw") + (
        "SELECT id, observe_date, sensor_values, false AS imported,"
        " CAST(observe_date AS DATE) AS obs_day FROM raw"
    )
    sql["append_minute_rollup"] = with_("rollup") + (
        "SELECT id, observe_date, node_model_id, sensor_value, node_unique_id,"
        " false AS imported, CAST(observe_date AS DATE) AS obs_day FROM rollup"
    )
    sql["pending_json_feed"] = with_("named") + f"""SELECT {feed_doc()} AS observation_data FROM (
        SELECT * FROM named WHERE NOT imported ORDER BY observe_date DESC, id LIMIT 25)"""
    sql["quarterhour_json_feed"] = with_("long_node_flagged") + f"""
        SELECT '{{"datum":"' || strftime(datum, '%Y-%m-%d') || '","hour":' || hour
            || ',"quarterhour":"' || quarterhour || '","sensor_name":"' || sensor_name
            || '","node_unique_id":' || coalesce('"' || node_unique_id || '"', 'null')
            || ',"timezone":"' || timezone || '","end_15min":"'
            || strftime(end_15min, '%Y-%m-%dT%H:%M:%S') || '","sensor_value":'
            || coalesce(printf('%.2f', sensor_value), 'null')
            || ',"submitted_to_api":' || submitted_to_api || '}}' AS observation_data
        FROM (SELECT * FROM long_node_flagged
              WHERE {KEYED_AS_OF} > end_15min + INTERVAL 1 MINUTE AND submitted_to_api = 0
              ORDER BY datum, quarterhour, sensor_name, node_unique_id NULLS FIRST, timezone
              LIMIT 10)"""
    sql["quarterhour_json_feed_first"] = with_("zoned") + f"""
        SELECT '{{"datum":"' || strftime(datum, '%Y-%m-%d') || '","hour":' || hour
            || ',"quarterhour":"' || quarterhour || '","observation_cnt":' || observation_cnt
            || ',"dht11_t":' || coalesce(printf('%.1f', dht11_t), 'null')
            || ',"dht11_h":' || coalesce(printf('%.0f', dht11_h), 'null')
            || ',"ds18b20_t":' || coalesce(printf('%.1f', ds18b20_t), 'null')
            || ',"end_15min":"' || strftime(end_15min, '%Y-%m-%dT%H:%M:%S')
            || '+00:00","timezone":"' || timezone || '"}}' AS observation_data
        FROM (SELECT * FROM zoned WHERE {AS_OF} > end_15min
              ORDER BY datum, quarterhour, timezone LIMIT 10)"""
    sql["calendar_dim"] = f"""SELECT datum, n_events,
            CAST(date_diff('day', DATE '2018-01-01', datum) + 1 AS INTEGER) AS calendar_id,
            {calendar_sql('datum')}
        FROM (SELECT CAST(ts AS DATE) AS datum, count(*) AS n_events FROM events GROUP BY 1)"""
    sql["time_dim"] = f"""SELECT time_id, n_events, strftime(t, '%H:%M:%S') AS timeofday,
            CAST(hour(t) AS INTEGER) AS hour, CAST(minute(t) AS INTEGER) AS minute,
            CAST(second(t) AS INTEGER) AS second, {quarter_label_sql('t')} AS quarterhour,
            {day_part_sql('t')}
        FROM (SELECT time_id, count(*) AS n_events,
                TIMESTAMP '2000-01-01' + to_seconds(CAST(time_id - 1 AS BIGINT)) AS t
              FROM (SELECT CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 1 AS INTEGER)
                    AS time_id FROM events) GROUP BY time_id)"""
    sql["sensor_catalogue"] = with_("readings", "models") + """
        SELECT m.id, m.name, m.column_name, m.value_type_id, m.value_unit_id,
            count(*) AS n_readings
        FROM readings r JOIN models m ON m.column_name = r.sensor_name
        WHERE v IS NOT NULL GROUP BY ALL"""
    sql["gen_observations"] = f"""SELECT event_id + 1 AS id, make_timestamp(
            epoch_us(TIMESTAMP '2018-01-01') + (event_id + 1) * 10000000
            + CAST(trunc(({draw('event_id + 1', 'late')} * 3 - {draw('event_id + 1', 'early')} * 2)
                * 10 / 2.0) AS BIGINT)) AS observe_date,
            '{SYNTHETIC_PAYLOAD}' AS sensor_values FROM events"""
    sql["gen_observations_v1"] = f"""SELECT event_id + 1 AS observation_id,
            CAST({draw('event_id + 1', 'day')} * 365 // 1000000 + 1 AS INTEGER) AS calendar_id,
            CAST({draw('event_id + 1', 'second')} * 86398 // 1000000 + 1 AS INTEGER) AS time_id,
            'America/Denver' AS timezone, '{SYNTHETIC_PAYLOAD}' AS sensor_values, false AS imported
        FROM events"""
    sql["schema_contract"] = with_("raw") + " UNION ALL ".join(
        f"SELECT 'observation_raw' AS table_name, '{c}' AS column_name,"
        f" count(*) AS n_rows, count({c}) AS n_filled FROM raw"
        for c in ("id", "observe_date", "sensor_values", "imported")
    )
    sql["append_receipts"] = with_("long_node_flagged") + f"""
        SELECT end_15min, sensor_name, node_unique_id FROM receipts
        UNION SELECT end_15min, sensor_name, node_unique_id FROM long_node_flagged
        WHERE {AS_OF} > end_15min + INTERVAL 1 MINUTE AND submitted_to_api = 0"""

    # projections, filters, predicates
    sql["parse_lines"] = with_("parsed") + """SELECT station, line_no, arrived_at, key,
        node_unique_id, value FROM parsed WHERE reject_reason IS NULL"""
    sql["parse_quarantine"] = with_("parsed") + """SELECT station, line_no, line, reject_reason
        FROM parsed WHERE reject_reason IS NOT NULL"""
    sql["node_id_extract"] = with_("parsed") + """SELECT station, line_no, key, node_unique_id
        FROM parsed WHERE reject_reason IS NULL AND node_unique_id IS NOT NULL"""
    sql["sentinel_filter"] = with_("node_rows") + f"""SELECT id, node_unique_id,
        {shown('v')} AS sensor_value FROM node_rows WHERE v <> -127000000"""
    sql["json_key_present"] = with_("raw") + """SELECT id, sensor_values FROM raw
        WHERE json_extract_string(sensor_values, '$.ds18b20_t_uq') IS NOT NULL"""
    sql["any_sensor_present"] = with_("raw") + """SELECT id, sensor_values FROM raw
        WHERE json_extract_string(sensor_values, '$.dht11_t') <> ''
            OR json_extract_string(sensor_values, '$.dht11_h') <> ''
            OR json_extract_string(sensor_values, '$.ds18b20_t') <> ''"""
    sql["closed_minutes"] = with_("raw") + f"""SELECT id, observe_date FROM raw
        WHERE date_trunc('minute', observe_date) < date_trunc('minute', {AS_OF})"""
    keyed_columns = "observation_id, calendar_id, time_id, timezone"
    sql["closed_minutes_tz"] = with_("gated") + f"SELECT {keyed_columns} FROM gated WHERE closed"
    sql["closed_minutes_tz_wrap"] = with_("gated") + f"""SELECT {keyed_columns} FROM gated
        WHERE datum <> CAST(local_now AS DATE)
            OR strftime(tstamp + INTERVAL 2 MINUTE, '%H:%M') < strftime(local_now, '%H:%M')"""
    sql["not_imported"] = with_("raw") + (
        "SELECT id, observe_date, imported FROM raw WHERE NOT imported"
    )
    sql["expired_rows"] = with_("raw") + f"""SELECT id, observe_date FROM raw
        WHERE imported AND {AS_OF} - INTERVAL 2 HOUR > observe_date"""
    sql["elapsed_windows"] = with_("zoned") + f"""SELECT datum, quarterhour, timezone, end_15min
        FROM zoned WHERE {AS_OF} > end_15min"""
    sql["daypart_labels"] = f"SELECT event_id, {day_part_sql('ts')} FROM events"
    sql["unpivot_sensors"] = with_("readings") + f"""SELECT id, sensor_name, node_unique_id,
        {shown('v')} AS sensor_value FROM readings"""
    sql["enrich_payload"] = with_("named") + f"""SELECT id,
        {feed_doc(',"api_key":"key-1","sensor_id":"sensor-1"')} AS observation_data
        FROM named WHERE NOT imported"""
    sql["submitted_flag"] = with_("long_node_flagged") + """SELECT sensor_name, timezone,
        submitted_to_api, count(*) AS n_windows FROM long_node_flagged GROUP BY ALL"""

    # joins
    sql["star_join_observations"] = with_("keyed_at") + f"""SELECT tstamp, datum,
        strftime(datum, '%d/%m/%Y') AS formatteddate, CAST(year(datum) AS INTEGER) AS year,
        CAST(month(datum) AS INTEGER) AS month, strftime(tstamp, '%H:%M:%S') AS timeofday,
        CAST(hour(tstamp) AS INTEGER) AS hour, CAST(minute(tstamp) AS INTEGER) AS minute,
        {day_part_sql('tstamp')}, {quarter_label_sql('tstamp')} AS quarterhour,
        timezone, sensor_values FROM keyed_at"""
    incoming = """(SELECT 'e' || event_id AS source_id, ts AS obs_time, 'UTC' AS timezone FROM events
        UNION ALL SELECT 'o' || o_orderkey, o_orderdate, 'UTC' FROM orders)"""
    in_calendar = """CAST(obs_time AS DATE) BETWEEN DATE '2018-01-01'
        AND DATE '2018-01-01' + 28400"""
    sql["dim_key_lookup"] = f"""SELECT source_id, timezone,
            CAST(date_diff('day', DATE '2018-01-01', CAST(obs_time AS DATE)) + 1 AS INTEGER) AS calendar_id,
            CAST(hour(obs_time) * 3600 + minute(obs_time) * 60 + second(obs_time) + 1 AS INTEGER)
                AS time_id
        FROM {incoming} WHERE {in_calendar}"""
    sql["dim_key_rejects"] = f"SELECT * FROM {incoming} WHERE NOT ({in_calendar})"
    sql["attach_node_model"] = with_("readings", "models") + f"""SELECT r.id,
        m.id AS node_model_id, sensor_name, node_unique_id, {shown('v')} AS sensor_value
        FROM readings r JOIN models m ON m.column_name = r.sensor_name"""
    sql["observation_named"] = with_("named") + "SELECT * FROM named"
    sql["cross_join_filter"] = with_("readings", "models") + """SELECT m.name, type_name, unit_name,
        count(*) AS n_readings FROM readings r JOIN models m ON m.column_name = r.sensor_name
        WHERE v IS NOT NULL GROUP BY ALL"""
    sql["semi_join_eligible"] = with_("gated") + f"""SELECT {keyed_columns}, sensor_values
        FROM gated WHERE closed AND NOT imported"""
    sql["join_with_residual"] = with_("gated") + f"""SELECT {keyed_columns}, ds18b20_t FROM (
            SELECT *, CAST(json_extract_string(sensor_values, '$.ds18b20_t') AS DOUBLE) AS ds18b20_t
            FROM gated WHERE closed AND NOT imported)
        WHERE ds18b20_t <> -127"""
    sql["minute_key_join"] = with_("keyed") + """SELECT calendar_id,
        CAST((time_id - 1) // 60 * 60 + 1 AS INTEGER) AS time_id, count(*) AS n_rows
        FROM keyed GROUP BY 1, 2"""
    sql["mark_imported"] = with_("loaded") + """SELECT id, observe_date,
        imported OR date_trunc('minute', observe_date) IN (SELECT observe_date FROM loaded)
            AS imported FROM raw"""
    sql["mark_imported_v1"] = with_("minute_fact") + """SELECT observation_id, k.calendar_id, k.time_id,
        imported OR m.calendar_id IS NOT NULL AS imported
        FROM keyed k LEFT JOIN (SELECT DISTINCT calendar_id, time_id FROM minute_fact) m
            ON m.calendar_id = k.calendar_id AND m.time_id = (k.time_id - 1) // 60 * 60 + 1"""
    sql["left_join_receipts"] = with_("zoned_flagged") + """SELECT datum, quarterhour, timezone,
        end_15min, submitted_to_api FROM zoned_flagged"""
    sql["left_join_receipts_2k"] = with_("long_sensor_flagged") + """SELECT end_15min, sensor_name,
        timezone, submitted_to_api FROM long_sensor_flagged"""
    sql["left_join_null_tolerant"] = with_("long_node_flagged") + """SELECT end_15min, sensor_name,
        node_unique_id, timezone, submitted_to_api FROM long_node_flagged"""
    sql["left_join_zone_aware"] = with_("long_node", "receipts") + """SELECT l.end_15min, l.sensor_name,
        l.node_unique_id, l.timezone,
        CAST(CASE WHEN r.end_15min IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS submitted_to_api
        FROM long_node l LEFT JOIN (
            SELECT DISTINCT end_15min, sensor_name, coalesce(node_unique_id, '') AS node FROM receipts) r
            ON timezone('UTC', timezone(l.timezone, l.end_15min)) = r.end_15min
            AND l.sensor_name = r.sensor_name AND coalesce(l.node_unique_id, '') = r.node"""

    # aggregations
    sql["minute_avg_nodes"] = with_("minutes") + (
        "SELECT * FROM minutes WHERE sensor_name = 'ds18b20_t'"
    )
    sql["minute_avg_scalar"] = with_("minutes") + (
        "SELECT * FROM minutes WHERE sensor_name <> 'ds18b20_t'"
    )
    sql["minute_rollup_v1"] = with_("minute_fact") + "SELECT * FROM minute_fact"
    wide = f"""CAST(count(*) AS INTEGER) AS observation_cnt, {mean(1, 'tv')} AS dht11_t,
        {mean(0, 'hv')} AS dht11_h, {mean(1, 'dv')} AS ds18b20_t"""
    sql["minute_summary_wide"] = with_("keyed_wide") + f"""SELECT datum, CAST(hh AS INTEGER) AS hour,
        CAST(mm AS INTEGER) AS minute, {wide} FROM keyed_wide GROUP BY datum, hh, mm"""
    sql["ordered_summary"] = sql["minute_summary_wide"] + " ORDER BY datum, hour, minute"
    sql["quarterhour_wide"] = with_("keyed_wide") + f"""SELECT datum, CAST(hh AS INTEGER) AS hour,
        quarterhour, {wide} FROM keyed_wide GROUP BY datum, hh, quarterhour"""
    sql["quarterhour_wide_tz"] = with_("zoned") + "SELECT * FROM zoned"
    sql["quarterhour_wide_flagged"] = with_("zoned_flagged") + "SELECT * FROM zoned_flagged"
    sql["quarterhour_long"] = with_("long_sensor_flagged") + "SELECT * FROM long_sensor_flagged"
    sql["quarterhour_long_nodes"] = with_("long_node_flagged") + "SELECT * FROM long_node_flagged"
    sql["distinct_minutes"] = with_("minute_fact") + (
        "SELECT DISTINCT calendar_id, time_id FROM minute_fact"
    )
    sql["dedupe_batch_lines"] = with_("batches") + """SELECT station,
        CAST(batch_no AS BIGINT) AS batch_no, line, max(line_no) AS line_no
        FROM batches GROUP BY 1, 2, 3"""
    sql["assemble_observations"] = with_("assembled") + "SELECT * FROM assembled"
    sql["backlog_count"] = with_("rollup") + (
        "SELECT count(*) AS pending FROM rollup WHERE NOT imported"
    )

    # numbering
    sql["row_number_ids"] = """SELECT o_orderkey, o_orderdate,
        row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id FROM orders"""
    sql["count_window_batches"] = with_("batches") + (
        "SELECT station, line_no, CAST(batch_no AS BIGINT) AS batch_no FROM batches"
    )

    # sorts and limits
    sql["top25_pending"] = with_("named") + """SELECT * FROM named WHERE NOT imported
        ORDER BY observe_date DESC, id LIMIT 25"""
    sql["oldest10_windows"] = with_("long_node_flagged") + f"""SELECT * FROM long_node_flagged
        WHERE {KEYED_AS_OF} > end_15min + INTERVAL 1 MINUTE AND submitted_to_api = 0
        ORDER BY datum, quarterhour, sensor_name, node_unique_id NULLS FIRST, timezone LIMIT 10"""

    # set operations
    sql["union_distinct_readings"] = with_("probe") + f"""SELECT id, observe_date, imported,
        node_unique_id, {shown('v')} AS sensor_value FROM probe"""
    sql["union_scalar_sensors"] = with_("scalar") + f"""SELECT id, observe_date, imported,
        sensor_name, {shown('v')} AS sensor_value FROM scalar"""
    sql["union_minute_views"] = with_("loadable") + "SELECT * FROM loadable"
    sql["union_distinct_per_second"] = with_("keyed_readings") + f"""SELECT DISTINCT calendar_id,
        time_id, timezone, sensor_name, node_unique_id, {shown('v')} AS sensor_value
        FROM keyed_readings"""

    # scalar functions
    # thousandths are exact integers: cents * 18 / 1000, rounded half up to cents
    sql["celsius_to_fahrenheit"] = """SELECT event_id,
        CAST((CAST(CAST(value AS DECIMAL(12,2)) * 100 AS BIGINT) * 18 + 32000 + 5) // 10 AS DOUBLE)
            / 100 AS fahrenheit FROM events"""
    sql["json_functions"] = with_("raw") + """SELECT id,
        json_extract_string(sensor_values, '$.dht11_t') AS as_text,
        json_extract(sensor_values, '$.ds18b20_t_uq') IS NOT NULL AS has_nodes,
        CAST(coalesce(json_array_length(sensor_values, '$.ds18b20_t_uq'), 0) AS INTEGER) AS n_elements,
        '{"id":' || id || ',"imported":' || CAST(imported AS VARCHAR) || '}' AS row_doc FROM raw"""
    sql["numeric_functions"] = f"""SELECT l_suppkey, {mean(2)} AS mean_2, {mean(0)} AS mean_0,
        CAST(count(*) AS INTEGER) AS n_rows, max(CAST(floor(l_quantity) AS BIGINT) % 15) AS max_mod
        FROM (SELECT *, {micro('l_extendedprice')} AS v FROM lineitem) GROUP BY l_suppkey"""
    sql["calendar_functions"] = f"""SELECT o_orderkey, datum, {calendar_sql('datum')}
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS datum FROM orders)"""
    sql["time_functions"] = f"""SELECT event_id, date_trunc('minute', ts) AS minute_start,
        date_trunc('second', ts) AS second_start, CAST(hour(ts) AS INTEGER) AS hour,
        CAST(minute(ts) AS INTEGER) AS minute, CAST(second(ts) AS INTEGER) AS second,
        strftime(ts, '%H:%M:%S') AS timeofday, {quarter_label_sql('ts')} AS quarterhour,
        {_QUARTER_END.format(ts='ts')} AS end_15min, date_trunc('second', ts) AS tstamp,
        ts + INTERVAL 2 HOUR AS plus_2h,
        CAST(CAST(ts AS DATE) + INTERVAL 1 MONTH AS DATE) AS plus_month FROM events"""
    sql["timezone_functions"] = with_("keyed_at") + """SELECT observation_id, timezone,
        timezone('UTC', timezone(timezone, tstamp)) AS as_instant,
        timezone(timezone, timezone('UTC', tstamp)) AS as_local FROM keyed_at"""
    sql["string_functions"] = with_("lines") + """SELECT line_no, station || '/' || line AS joined,
        right(line, 5) AS tail,
        CASE WHEN contains(line, ':') THEN string_split(line, ':')[2] ELSE '' END AS second_part,
        substr(line, 1, 10) AS prefix,
        CASE WHEN starts_with(line, 'ds18b20_t_') THEN substr(line, 11) ELSE '' END AS rest,
        CASE WHEN line = '' THEN 'blank' ELSE 'text' END AS kind FROM lines"""

    # state changes
    sql["surrogate_ids"] = with_("assembled") + """SELECT 1000 + row_number() OVER (
        ORDER BY substr(md5(station), 1, 3), station, batch_no) AS id, station, batch_no
        FROM assembled"""
    sql["load_closed_minutes"] = with_("loaded") + "SELECT * FROM loaded"
    sql["load_flags"] = with_("raw") + f"""SELECT id, imported
        OR date_trunc('minute', observe_date) IN (
            SELECT date_trunc('minute', observe_date) FROM raw
            WHERE NOT imported AND observe_date < {OPEN_MINUTE}) AS imported FROM raw"""
    sql["load_quarantine"] = with_("loadable") + """SELECT observe_date, node_model_id,
        node_unique_id, 'no_value' AS reject_reason FROM loadable WHERE sensor_value IS NULL"""
    sql["load_closed_minutes_v1"] = with_("gated") + (
        "SELECT observation_id, imported OR closed AS imported FROM gated"
    )
    early = BLOCKS["gated"].replace(KEYED_AS_OF, AS_OF)
    two = with_("keyed_at") + f""", gated AS ({BLOCKS['gated']}),
        keyed_probe AS ({BLOCKS['keyed_probe']}), keyed_readings AS ({BLOCKS['keyed_readings']}),
        new_rows AS (SELECT calendar_id, time_id, timezone, sensor_name, node_unique_id,
            {mean(2)} AS sensor_value
            FROM (SELECT DISTINCT calendar_id, time_id AS second_id,
                      CAST((time_id - 1) // 60 * 60 + 1 AS INTEGER) AS time_id,
                      timezone, sensor_name, node_unique_id, v
                  FROM keyed_readings WHERE closed AND NOT imported AND observation_id < 0)
            GROUP BY ALL),
        early_ids AS (SELECT observation_id FROM ({early}) WHERE closed AND NOT imported),
        old_rows AS (SELECT calendar_id, time_id, timezone, sensor_name, node_unique_id,
            {mean(2)} AS sensor_value
            FROM (SELECT DISTINCT calendar_id, time_id AS second_id,
                      CAST((time_id - 1) // 60 * 60 + 1 AS INTEGER) AS time_id,
                      timezone, sensor_name, node_unique_id, v
                  FROM keyed_readings WHERE observation_id IN (SELECT observation_id FROM early_ids))
            GROUP BY ALL)
        """
    upsert = """SELECT o.* FROM old_rows o WHERE NOT EXISTS (SELECT 1 FROM new_rows n
            WHERE n.calendar_id = o.calendar_id AND n.time_id = o.time_id
            AND n.timezone = o.timezone AND n.sensor_name = o.sensor_name
            AND n.node_unique_id {same} o.node_unique_id)
        UNION ALL SELECT * FROM new_rows"""
    sql["upsert_minutes"] = two + upsert.format(same="=")
    sql["upsert_minutes_nullsafe"] = two + upsert.format(same="IS NOT DISTINCT FROM")
    sql["retention_keep"] = with_("raw") + f"""SELECT id, observe_date, imported FROM raw
        WHERE NOT (imported AND {AS_OF} - INTERVAL 2 HOUR > observe_date)"""
    sql["apply_acks"] = with_("rollup") + (
        "SELECT id, imported OR id % 10 <= 6 AS imported FROM rollup"
    )
    sql["reprocess_all"] = with_("readings", "models") + f"""SELECT * FROM (
        SELECT date_trunc('minute', observe_date) AS observe_date, m.id AS node_model_id,
            {mean(6)} AS sensor_value, node_unique_id
        FROM readings r JOIN models m ON m.column_name = r.sensor_name
        WHERE observe_date < {OPEN_MINUTE} GROUP BY 1, 2, 4) WHERE sensor_value IS NOT NULL"""
    sql["schema_backfill"] = with_("receipts") + """SELECT DISTINCT end_15min, '' AS sensor_name,
        CAST(1 AS INTEGER) AS sensor_id FROM receipts"""

    sql["upsert_stored"] = sql["upsert_minutes"]
    sql["upsert_stored_nullsafe"] = sql["upsert_minutes_nullsafe"]
    sql["reprocess_generation"] = sql["reprocess_all"]
    sql["schema_versions"] = with_("receipts") + """
        SELECT end_15min, '' AS sensor_name, CAST(NULL AS VARCHAR) AS node_unique_id, CAST(1 AS INTEGER) AS sensor_id
        FROM receipts UNION ALL SELECT end_15min, sensor_name, NULL, 1 FROM receipts
        UNION ALL SELECT end_15min, sensor_name, node_unique_id, 2 FROM receipts"""

    # data quality
    def dup(table: str, keys: str, source: str | None = None) -> str:
        present = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(","))
        return (
            f"SELECT 'unique' AS check_name, '{table}' AS table_name, '{keys}' AS key_name,"
            f" count(*) AS n_bad FROM (SELECT {keys} FROM {source or table} WHERE {present}"
            f" GROUP BY {keys} HAVING count(*) > 1)"
        )

    sql["dq_unique"] = with_("minute_fact") + " UNION ALL ".join([
        dup("orders", "o_orderkey"), dup("orders", "o_custkey"),
        dup("lineitem", "l_orderkey,l_linenumber"), dup("events", "event_id"),
        dup("observation_minute", "calendar_id,time_id,sensor_name,node_unique_id", "minute_fact"),
    ])

    def orphans(child: str, key: str, parent: str, parent_key: str) -> str:
        return (
            f"SELECT 'foreign_key' AS check_name, '{child}' AS table_name, '{key}' AS key_name,"
            f" count(*) AS n_bad FROM {child} c WHERE {key} IS NOT NULL AND NOT EXISTS"
            f" (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key})"
        )

    sql["dq_foreign_key"] = " UNION ALL ".join([
        orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
        orphans("orders", "o_custkey", "customer", "c_custkey"),
        orphans("customer", "c_nationkey", "nation", "n_nationkey"),
        orphans("lineitem", "l_partkey", "supplier", "s_suppkey"),
    ])

    def nulls(table: str, source: str, columns: str) -> str:
        return " UNION ALL ".join(
            f"SELECT 'not_null' AS check_name, '{table}' AS table_name, '{c}' AS key_name,"
            f" count(*) - count({c}) AS n_bad FROM {source}" for c in columns.split(",")
        )

    sql["dq_not_null"] = with_("raw", "parsed") + " UNION ALL ".join([
        nulls("observation_raw", "raw", "id,observe_date,sensor_values,imported"),
        nulls("lines", "parsed", "station,line,value,node_unique_id"),
    ])
    sql["dq_numeric_range"] = """SELECT 'numeric_range' AS check_name, 'orders' AS table_name,
            'total_x10' AS key_name,
            count(CASE WHEN CAST(o_totalprice AS DECIMAL(18,2)) * 10 >= 1000000 THEN 1 END) AS n_bad
        FROM orders UNION ALL SELECT 'numeric_range', 'lineitem', 'l_extendedprice',
            count(CASE WHEN l_extendedprice >= 1000000 THEN 1 END) FROM lineitem"""
    sql["dq_json"] = with_("raw") + """SELECT 'json' AS check_name, 'events' AS table_name,
            'props' AS key_name, count(CASE WHEN NOT json_valid(props) THEN 1 END) AS n_bad FROM events
        UNION ALL SELECT 'json', 'events', 'event_type',
            count(CASE WHEN NOT json_valid(event_type) THEN 1 END) FROM events
        UNION ALL SELECT 'json', 'observation_raw', 'sensor_values',
            count(CASE WHEN NOT json_valid(sensor_values) THEN 1 END) FROM raw
        UNION ALL SELECT 'finite', 'events', 'value',
            count(CASE WHEN isnan(value) OR isinf(value) THEN 1 END) FROM events"""
    sql["dq_unreadable_values"] = with_("parsed") + """SELECT line_no AS id,
        'dht11_t' AS sensor_name, raw_value AS text FROM parsed WHERE reject_reason = 'not_numeric'"""

    sql["dq_unreadable_nodes"] = """SELECT event_id AS id, unnest(['B', 'H', 'O']) AS node_unique_id,
            unnest(['bad', '1.0E15', '{"q":1}']) AS text FROM events WHERE event_type = 'click'
        UNION ALL SELECT event_id, NULL, '{"N9":3}' FROM events
        WHERE event_type NOT IN ('click', 'signup', 'purchase')"""
    sql["minute_avg_nodes_spoiled"] = sql["minute_avg_nodes"]
    sql["scan_line_files"] = with_("lines") + """SELECT station,
        row_number() OVER (PARTITION BY station ORDER BY line_no) AS line_no, line
        FROM lines WHERE line <> ''"""
    sql["null_key_numbers"] = """SELECT event_id, kind, part, row_number() OVER (
            PARTITION BY kind ORDER BY part NULLS FIRST, event_id) AS row_no
        FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS kind,
            CASE WHEN user_id % 5 <> 0 THEN user_id % 5 END AS part FROM events)"""
    # streams
    sql["stream_minute_avg_in_order"] = with_("readings", "models", "watermark") + f"""SELECT * FROM (
        SELECT date_trunc('minute', observe_date) AS observe_date, m.id AS node_model_id,
            sensor_name, node_unique_id, {mean(6)} AS sensor_value
        FROM readings r JOIN models m ON m.column_name = r.sensor_name GROUP BY 1, 2, 3, 4)
        WHERE observe_date + INTERVAL 1 MINUTE <= (SELECT seen FROM watermark)"""
    sql["stream_quarterhour_avg_in_order"] = with_("readings", "watermark") + f"""
        , minute_means AS (SELECT date_trunc('minute', observe_date) AS moment, sensor_name,
            node_unique_id, {mean(2)} AS m FROM readings GROUP BY 1, 2, 3)
        , quarter_means AS (SELECT date_trunc('hour', moment)
                + to_minutes(CAST(minute(moment) // 15 * 15 AS BIGINT)) AS start_15min, sensor_name,
            node_unique_id, {mean(2, 'CAST(round(m * 1000000) AS BIGINT)')} AS sensor_value
            FROM minute_means GROUP BY 1, 2, 3)
        SELECT start_15min, start_15min + INTERVAL 14 MINUTE AS end_15min, sensor_name,
            node_unique_id, sensor_value FROM quarter_means
        WHERE start_15min + INTERVAL 15 MINUTE <= (SELECT seen FROM watermark) - INTERVAL 2 MINUTE"""
    sql["stream_ingest_raw"] = with_("assembled") + (
        "SELECT observe_date, sensor_values, true AS dense FROM assembled"
    )
    split = "FROM lines WHERE line <> ''"
    sql["ingest_after_expiry"] = with_("assembled").replace(
        split, f"{split} AND arrived_at >= {AS_OF}"
    ) + f""", before AS (SELECT sum(n // 7) AS n FROM (SELECT station, count(*) AS n {split}
            AND arrived_at < {AS_OF} GROUP BY station))
        SELECT observe_date, sensor_values, CAST((SELECT coalesce(n, 0) FROM before) + 1 AS BIGINT) AS first_id,
            CAST((SELECT coalesce(n, 0) FROM before) + count(*) OVER () AS BIGINT) AS last_id FROM assembled"""
    sql["pending_feed_noted"] = sql["pending_json_feed"]
    sql["acks_folded"] = with_("rollup") + (
        "SELECT id, id % 10 <= 6 OR id % 3 = 0 AS imported FROM rollup"
    )
    sql["outbox_attempts"] = with_("rollup") + """
        , refused AS (SELECT id, observe_date FROM rollup WHERE id % 100 = 8
            ORDER BY observe_date DESC, id LIMIT 1)
        , seen AS (SELECT r.id, r.id % 10 AS digit, r.id % 100 = 8 AS refused, coalesce(
                r.observe_date < f.observe_date OR r.observe_date = f.observe_date AND r.id > f.id, false) AS behind
            FROM rollup r LEFT JOIN refused f ON true)
        SELECT id, CASE WHEN digit IN (0, 1, 2, 9) THEN 1::BIGINT WHEN digit IN (3, 4) OR behind THEN 2 ELSE 3 END AS attempts,
            CASE WHEN digit IN (0, 1, 2, 3, 4, 9) THEN 'acked' WHEN digit IN (6, 7) THEN 'pending'
                WHEN digit = 5 THEN CASE WHEN behind THEN 'retry' ELSE 'acked' END
                WHEN behind THEN 'pending' WHEN refused THEN 'fatal' ELSE 'acked' END AS last_outcome,
            digit IN (0, 1, 2, 3, 4, 9) OR digit IN (5, 8) AND NOT behind AND NOT refused AS imported
        FROM seen"""
    sql["load_folded"] = f"SELECT * EXCLUDE (id) FROM ({sql['append_minute_rollup']})"
    sql["load_repeat"] = sql["append_minute_rollup"]
    sql["expire_in_place"] = sql["retention_keep"]
    # Over deliveries in any order: the same, by the exact time of the latest reading.
    exact = ("date_trunc('millisecond', max(observe_date))", "max(observe_date)")
    for name in ("stream_minute_avg", "stream_quarterhour_avg"):
        sql[name] = sql[f"{name}_in_order"].replace(*exact)
    sql["stream_count_window"] = sql["assemble_observations"]
    sql["late_append"] = with_("partials") + f"""SELECT observe_date, sensor_name, node_unique_id,
        CAST(micro_batch AS BIGINT) AS micro_batch, {mean(2)} AS sensor_value
        FROM partials GROUP BY 1, 2, 3, 4"""
    sql["late_overwrite"] = with_("partials") + f"""SELECT observe_date, sensor_name,
            node_unique_id, {mean(2)} AS sensor_value
        FROM (SELECT *, max(micro_batch) OVER (PARTITION BY observe_date, sensor_name, node_unique_id)
                AS last_batch FROM partials)
        WHERE micro_batch = last_batch GROUP BY 1, 2, 3"""
    sql["late_merge_exact"] = with_("partials") + f"""SELECT observe_date, sensor_name,
        node_unique_id, {mean(2)} AS sensor_value FROM partials GROUP BY 1, 2, 3"""
    for policy, name in (("append", "append"), ("overwrite", "overwrite"), ("exact", "merge_exact")):
        sql[f"late_{policy}_sealed"] = sql[f"late_{name}"]
    pause = "CAST(CASE WHEN outcome = 'retry' THEN 25.0 ELSE 0.0 END AS DOUBLE) AS retry_after_s"
    sql["outbox_route_status"] = with_("routed") + f"SELECT id, outcome, {pause} FROM routed"
    sql["outbox_route_stop"] = with_("routed") + f"""SELECT id, outcome, {pause} FROM (
        SELECT r.id, CASE WHEN f.id IS NOT NULL AND (r.observe_date < f.observe_date
                OR (r.observe_date = f.observe_date AND r.id > f.id)) THEN 'pending'
            ELSE outcome END AS outcome
        FROM routed r LEFT JOIN (SELECT id, observe_date FROM routed WHERE outcome = 'fatal'
            ORDER BY observe_date DESC, id LIMIT 1) f ON true)"""
    return sql
