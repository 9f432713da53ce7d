"""Fixed values of the data model: sensor keys, seed rows, labels and limits."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

# --- fixed values: sensor keys -------------------------------------------------
HUMIDITY_KEY = "dht11_h"
TEMPERATURE_KEY = "dht11_t"
PROBE_KEY = "ds18b20_t"
PROBE_ARRAY_KEY = "ds18b20_t_uq"
PROBE_LINE_PREFIX = "ds18b20_t_"
SCALAR_KEYS = (HUMIDITY_KEY, TEMPERATURE_KEY)
WIDE_KEYS = (TEMPERATURE_KEY, HUMIDITY_KEY, PROBE_KEY)
BAD_READING = Decimal(-127)

# --- fixed values: sensor catalogue seed rows ----------------------------------
VALUE_TYPES = ((1, "Temperature"), (2, "Humidity"))
VALUE_UNITS = ((1, "C"), (2, "%"))
# (id, model name, observation key, value type, value unit)
NODE_MODELS = (
    (1, "DHT-11 (T)", "dht11_t", "Temperature", "C"),
    (2, "DHT-11 (H)", "dht11_h", "Humidity", "%"),
    (3, "DS18B20", "ds18b20_t", "Temperature", "C"),
)

# --- fixed values: line batches per firmware configuration ---------------------
LINES_PER_BATCH = {"standard": 3, "expanded": 7}

# --- fixed values: dimensions --------------------------------------------------
CALENDAR_START = date(2018, 1, 1)
CALENDAR_DAYS = 28_401
SECONDS_PER_DAY = 86_400
# (first minute, last minute, label), both ends inside; anything else is Night
DAY_PARTS = (
    ("05:00", "08:29", "Early Morning"),
    ("08:30", "11:59", "Morning"),
    ("12:00", "17:59", "Afternoon"),
    ("18:00", "22:29", "Evening"),
)
DAY_PART_OTHERWISE = "Night"
DAYLIGHT = ("07:00", "19:59")
QUARTER_SEPARATOR = " – "

# --- fixed values: feeds, delivery and cadence ---------------------------------
PENDING_FEED_ROWS = 25
QUARTER_FEED_ROWS = 10
RETENTION_HOURS = 24
STATUS_CREATED = 201
STATUS_UNAUTHORIZED = 401
STATUS_NOT_FOUND = 404
SEND_PAUSE_S = 2.5
NOT_FOUND_PAUSE_S = SEND_PAUSE_S * 10
FEED_LOOP_S = 15 + SEND_PAUSE_S * 5
ROLLUP_TRIGGER = "1 minute"

# --- fixed values: synthetic data ----------------------------------------------
SYNTHETIC_ROWS_PER_WEEK = 50_400
SYNTHETIC_PAYLOAD = '{"dht11_h": 88.8, "dht11_t": 3.1, "ds18b20_t": 3.14}'
SYNTHETIC_START = "2018-01-01 00:00:00"
SYNTHETIC_STEP_S = 10
SYNTHETIC_DAYS = 365
SYNTHETIC_SECONDS = 86_398
SYNTHETIC_ZONE = "America/Denver"

# Working type of one reading, and type of a stored average.
READING_TYPE = "decimal(18,6)"
STORED_TYPE = "decimal(12,6)"
