"""Observation documents to long readings, in one pass over the documents.

Every document is parsed once.  De-duplication that is keyed by the observation id
is done inside the row, where it needs no shuffle: the id is the primary key, so
equal readings of one id can only come from one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.constants import (
    BAD_READING, HUMIDITY_KEY, PROBE_ARRAY_KEY, PROBE_KEY, READING_TYPE, SCALAR_KEYS,
    TEMPERATURE_KEY, WIDE_KEYS,
)
from gaugemill.functions import json_docs, numeric

RAW_KEYS = ("id", "observe_date", "imported")
_ITEM = f"struct<key:string,value:{READING_TYPE}>"


def not_bad(value: Column) -> Column:
    """Drops the known-bad reading; NULL is dropped as well."""
    return value != F.lit(BAD_READING).cast(READING_TYPE)


def with_key(raw: DataFrame, key: str) -> DataFrame:
    """Observations in which the key is present and not null."""
    return raw.filter(json_docs.has_value(F.col("sensor_values"), key))


def with_any_sensor(raw: DataFrame) -> DataFrame:
    """Observations with some non-empty scalar sensor value; one parse per document."""
    texts = F.array(json_docs.texts_of(F.col("sensor_values"), WIDE_KEYS))

    def any_text(doc: Column) -> Column:
        present = [F.coalesce(doc[key] != "", F.lit(False)) for key in WIDE_KEYS]
        return present[0] | present[1] | present[2]

    return raw.filter(F.exists(texts, any_text))


def wide_readings(raw: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The three scalar sensors as columns; ``has_reading`` tells whether there is any.

    Rows without a reading are not filtered here: a filter on parsed values would be
    pushed below the projection and parse every document again.
    """
    texts = json_docs.texts_of(F.col("sensor_values"), WIDE_KEYS)
    parsed = raw.select(*keep, texts.alias("_doc"))
    values = [numeric.to_number(F.col(f"_doc.{key}")) for key in WIDE_KEYS]
    named = [v.alias(key) for v, key in zip(values, WIDE_KEYS)]
    return parsed.select(*keep, *named, F.coalesce(*values).isNotNull().alias("has_reading"))


def _last_per_key(element: Column) -> Column:
    """Entries of one element; of a repeated key only the last value counts.

    Elements without a repeated key, found by hashing, skip the pairwise search.
    """
    entries = F.map_entries(element)
    repeated = (F.size(element) > 1) & (
        F.size(F.array_distinct(F.map_keys(element))) < F.size(element)
    )
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]
        ),
    )
    return F.when(repeated, last).otherwise(entries)


def _node_texts() -> Column:
    """All (key, text) entries of all elements of the node array; NULL without one."""
    none = F.array().cast("array<struct<key:string,value:string>>")
    elements = F.col(f"_doc.{PROBE_ARRAY_KEY}")
    return F.flatten(F.transform(elements, lambda m: F.coalesce(_last_per_key(m), none)))


def _node_items() -> Column:
    """All (key, value) entries of all elements of the node array; empty without one."""
    none = F.array().cast(f"array<{_ITEM}>")
    numbers = F.transform(
        _node_texts(),
        lambda e: F.struct(e["key"].alias("key"), numeric.to_number(e["value"]).alias("value")),
    )
    return F.coalesce(numbers, none)


def _long(
    raw: DataFrame,
    keep: Sequence[str],
    scalars: Sequence[str],
    nodes: Column | None = None,
) -> DataFrame:
    """One row per reading: the scalar keys by position, then the node entries.

    Items carry only (node, value); the sensor follows from the position, so no
    item is rebuilt.  The list is a column of its own, which keeps the row
    generation compiled, and the outer form keeps the optimizer from testing the
    list's size first, which would parse every document twice.
    """
    parsed = raw.select(*keep, json_docs.readings_of(F.col("sensor_values")).alias("_doc"))
    items = F.array(
        *[
            F.struct(
                F.lit(None).cast("string").alias("key"),
                numeric.to_number(F.col(f"_doc.{key}")).alias("value"),
            )
            for key in scalars
        ]
    )
    if nodes is not None:
        items = F.concat(items, nodes) if scalars else nodes
    rows = parsed.select(*keep, items.alias("_items")).select(
        *keep, F.posexplode_outer("_items").alias("_position", "_item")
    )
    # The row of an empty list has no position and no sensor.
    sensor = F.when(F.col("_position").isNotNull(), PROBE_KEY)
    for position, key in enumerate(scalars):
        if key != PROBE_KEY:
            sensor = F.when(F.col("_position") == position, key).otherwise(sensor)
    return rows.select(
        *keep,
        sensor.alias("sensor_name"),
        F.col("_item.key").alias("node_unique_id"),
        F.col("_item.value").alias("sensor_value"),
        "_position",
    )


def node_readings(raw: DataFrame, keep: Sequence[str] = RAW_KEYS) -> DataFrame:
    """One row per entry of the node array, nothing filtered."""
    rows = _long(raw, keep, [], _node_items())
    return rows.filter(F.col("_position").isNotNull()).select(
        *keep, "node_unique_id", "sensor_value"
    )


def probe_readings(
    raw: DataFrame, keep: Sequence[str] = RAW_KEYS, named: bool = False
) -> DataFrame:
    """Scalar and per-node probe readings, distinct within an observation, bad ones out.

    A scalar reading has no node, so only node readings can equal each other.
    """
    columns = [*(["sensor_name"] if named else []), "node_unique_id", "sensor_value"]
    rows = _long(raw, keep, [PROBE_KEY], F.array_distinct(_node_items()))
    return rows.filter(not_bad(F.col("sensor_value"))).select(*keep, *columns)


def scalar_readings(raw: DataFrame, keep: Sequence[str] = RAW_KEYS) -> DataFrame:
    """Humidity and temperature in long form; a missing sensor keeps a NULL row."""
    return _long(raw, keep, SCALAR_KEYS).select(*keep, "sensor_name", "sensor_value")


def all_readings(raw: DataFrame, keep: Sequence[str] = RAW_KEYS) -> DataFrame:
    """All sensors in long form: scalars with NULL rows, then the probe readings."""
    rows = _long(raw, keep, [*SCALAR_KEYS, PROBE_KEY], F.array_distinct(_node_items()))
    is_scalar = F.col("_position") < len(SCALAR_KEYS)
    return rows.filter(is_scalar | not_bad(F.col("sensor_value"))).select(
        *keep, "sensor_name", "node_unique_id", "sensor_value"
    )


def distinct_readings(raw: DataFrame, keep: Sequence[str]) -> DataFrame:
    """All sensors in long form, equal rows over *different* observations once.

    Without the id in the key, readings that agree in second, sensor, node and value
    collapse.  The key contains the value, so a hot second is reduced before the
    shuffle and split by value in it.
    """
    return all_readings(raw, keep).distinct()


def unreadable(raw: DataFrame) -> DataFrame:
    """Scalar values that are present but no number: (id, sensor_name, text)."""
    texts = json_docs.texts_of(F.col("sensor_values"), WIDE_KEYS)
    parsed = raw.select("id", texts.alias("_texts"))
    entries = F.array(
        *[
            F.struct(F.lit(k).alias("sensor_name"), F.col(f"_texts.{k}").alias("text"))
            for k in (HUMIDITY_KEY, TEMPERATURE_KEY, PROBE_KEY)
        ]
    )
    return parsed.select("id", F.inline(entries)).filter(
        F.col("text").isNotNull() & numeric.to_number(F.col("text")).isNull()
    )


def unreadable_nodes(raw: DataFrame) -> DataFrame:
    """Node values that are present but no number in range: (id, node_unique_id, text).

    A member that is no array of objects is listed whole, without a node.
    """
    doc = F.col("sensor_values")
    parsed = raw.select(
        "id",
        json_docs.readings_of(doc).alias("_doc"),
        json_docs.text_of(doc, PROBE_ARRAY_KEY).alias("_member"),
    )
    entries = F.transform(
        _node_texts(),
        lambda e: F.struct(e["key"].alias("node_unique_id"), e["value"].alias("text")),
    )
    whole = F.array(
        F.struct(F.lit(None).cast("string").alias("node_unique_id"), F.col("_member").alias("text"))
    )
    listed = F.when(F.col(f"_doc.{PROBE_ARRAY_KEY}").isNotNull(), entries).when(
        F.col("_member").isNotNull(), whole
    )
    rows = parsed.select("id", listed.alias("_listed")).select("id", F.inline_outer("_listed"))
    return rows.filter(F.col("text").isNotNull() & numeric.to_number(F.col("text")).isNull())


def quarantined(raw: DataFrame) -> DataFrame:
    """Everything of the documents that is no reading: (id, sensor_name, node_unique_id, text)."""
    scalars = unreadable(raw).select(
        "id", "sensor_name", F.lit(None).cast("string").alias("node_unique_id"), "text"
    )
    nodes = unreadable_nodes(raw).select(
        "id", F.lit(PROBE_KEY).alias("sensor_name"), "node_unique_id", "text"
    )
    return scalars.unionByName(nodes)
