"""Line sources: capture files of sensor stations, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugemill.operators import parsing
from gaugemill.operators.numbering import number_rows

STATION_IN_PATH = r"station=([^/]+)/"
# Position of a line: its file in order of arrival, the byte at which its part of the
# file starts, and its row in the task that reads that part.
POSITION = ("file_order", "part_start")


def _with_position(text: DataFrame) -> DataFrame:
    """Station from the folder name, arrival, line, and the line's position.

    Files come in order of their modification time, then path.  Rows of one part of a
    file are read by one task in file order, so their numbers ascend, with gaps; a
    repeated task gives the same order.
    """
    modified = F.col("_metadata.file_modification_time")
    file_order = F.concat(
        F.lpad(F.unix_micros(modified).cast("string"), 20, "0"), F.lit("|"), F.col("_metadata.file_path")
    )
    return text.select(
        F.regexp_extract(F.col("_metadata.file_path"), STATION_IN_PATH, 1).alias("station"),
        modified.alias("arrived_at"),
        F.col("value").alias("line"),
        file_order.alias("file_order"),
        F.col("_metadata.file_block_start").alias("part_start"),
    )


def with_part_row(placed: DataFrame) -> DataFrame:
    """Add ``line_no``, the row within the task: ascending within a part of a file."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("line_no", row)


def position_levels() -> dict:
    """Block keys of a line's position, coarse to fine."""
    return {"_file": F.col("file_order"), "_part": F.col("part_start")}


def read_line_files(spark: SparkSession, path: str) -> DataFrame:
    """Capture files ``<path>/station=<name>/<file>``, any number per station.

    ``line_no`` counts a station's non-blank lines over all its files, from 1.
    """
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    placed = with_part_row(parsing.drop_blank(_with_position(text)))
    numbered = number_rows(placed, ["station"], position_levels(), ["line_no"], out="row_no")
    return numbered.select("station", F.col("row_no").cast("long").alias("line_no"), "arrived_at", "line")


def stream_line_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream; each micro-batch holds the newly arrived files.

    Lines carry their position instead of a number: ``CountWindow`` orders them by it.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    placed = parsing.drop_blank(_with_position(reader.text(path)))
    return placed.select("station", "arrived_at", "line", *POSITION)


def scan_lines(lines: DataFrame) -> DataFrame:
    """Non-blank lines of an already tabular line source."""
    return parsing.drop_blank(lines).select("station", "line_no", "arrived_at", "line")
