"""Count windows over lines, and one observation document per full window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.constants import PROBE_ARRAY_KEY
from gaugemill.functions import json_docs
from gaugemill.operators import parsing
from gaugemill.operators.numbering import block_columns, number_rows


def line_levels(order: str = "line_no") -> dict[str, Column]:
    coarse, fine = block_columns(F.col(order))
    return {"_block_hi": coarse, "_block_lo": fine}


def number_lines(lines: DataFrame) -> DataFrame:
    """Number the non-blank lines of each station in line order.

    Adds ``row_no`` and the station's line count ``station_lines``.
    """
    return number_rows(
        parsing.drop_blank(lines), ["station"], line_levels(), ["line_no"],
        out="row_no", total="station_lines",
    )


def split_windows(numbered: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(lines of full batches with their ``batch_no``, waiting lines)."""
    batch = F.call_function("div", F.col("row_no") - 1, F.lit(size))
    full_batches = F.call_function("div", F.col("station_lines"), F.lit(size))
    columns = [c for c in numbered.columns if c not in ("row_no", "station_lines")]
    full = numbered.filter(batch < full_batches).select(*columns, batch.alias("batch_no"))
    return full, numbered.filter(batch >= full_batches).select(*columns)


def count_windows(lines: DataFrame, size: int) -> DataFrame:
    """Every ``size`` consecutive non-blank lines of a station form batch 0, 1, …

    Lines of the unfinished last batch are left out; they wait for more lines.
    """
    return split_windows(number_lines(lines), size)[0]


def dedupe_lines(batched: DataFrame) -> DataFrame:
    """Identical lines of one batch count once (the last one is kept)."""
    rest = [c for c in batched.columns if c not in ("station", "batch_no", "line")]
    return (
        batched.groupBy("station", "batch_no", "line")
        .agg(F.max_by(F.struct(*rest), F.col("line_no")).alias("_last"))
        .select("station", "batch_no", "line", *[F.col(f"_last.{c}").alias(c) for c in rest])
    )


def assemble(batched: DataFrame) -> DataFrame:
    """One observation per batch: scalar readings by key, node readings as an array.

    A batch has few lines by definition, so its readings are folded in array
    expressions after a single aggregation.  Equal lines count once; of several
    values for one key the last line wins; a batch without any good line gives an
    empty document.  The document is stamped with the arrival of its last line.
    """
    parsed = parsing.parse_lines(batched)
    reading = F.struct(
        F.col("line_no"), F.col("line"), F.col("key"), F.col("node_unique_id"),
        F.col("value").cast("double").alias("value"),
    )
    grouped = parsed.groupBy("station", "batch_no").agg(
        F.max_by("arrived_at", "line_no").alias("observe_date"),
        F.array_sort(
            F.collect_list(F.when(F.col("reject_reason").isNull(), reading))
        ).alias("_all"),
    )
    is_node = lambda r: r["node_unique_id"].isNotNull()
    later = lambda r, same: ~F.exists(
        F.col("_all"), lambda o: (o["line_no"] > r["line_no"]) & same(o, r)
    )
    scalars = F.filter(
        F.col("_all"),
        lambda r: ~is_node(r) & later(r, lambda o, s: o["key"].eqNullSafe(s["key"])),
    )
    nodes = F.filter(
        F.col("_all"),
        lambda r: is_node(r) & later(r, lambda o, s: o["line"].eqNullSafe(s["line"])),
    )
    members = F.transform(scalars, lambda r: json_docs.json_member(r["key"], r["value"]))
    node_docs = F.transform(
        nodes, lambda r: F.to_json(F.create_map(r["node_unique_id"], r["value"]))
    )
    node_member = F.when(
        F.size("_nodes") > 0,
        F.concat(F.lit(f'"{PROBE_ARRAY_KEY}":['), F.array_join("_nodes", ","), F.lit("]")),
    )
    return (
        grouped.withColumns({"_members": members, "_nodes": node_docs})
        .withColumn(
            "sensor_values",
            F.concat(
                F.lit("{"),
                F.array_join(F.array_compact(F.concat("_members", F.array(node_member))), ","),
                F.lit("}"),
            ),
        )
        .select("station", "batch_no", "observe_date", "sensor_values")
    )
