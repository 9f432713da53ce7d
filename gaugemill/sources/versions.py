"""Tables whose files were written under several schema versions.

Every file lies below the version it was written under.  A reader asks for the newest
version's columns and gets, for rows of an older version, the default of each column that
came later.  A NULL that was stored stays NULL.
"""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

VERSION = "schema_version"


class Evolved(NamedTuple):
    """A column, the version it came with, what older rows have, and the version it went with."""

    name: str
    type: str
    since: int = 1
    default: Any = None
    until: int | None = None

    def present(self, version: int) -> bool:
        return self.since <= version and (self.until is None or version < self.until)


def append_version(rows: DataFrame, path: str, columns: list[Evolved], version: int) -> None:
    """Append rows under a version, with exactly that version's columns."""
    now = [F.col(c.name).cast(c.type).alias(c.name) for c in columns if c.present(version)]
    rows.select(*now).write.mode("append").parquet(f"{path}/{VERSION}={version}")


def read_versions(
    spark: SparkSession, path: str, columns: list[Evolved], version: int
) -> DataFrame:
    """All rows in the form of ``version``; rows of later versions are read without later columns."""
    asked = [c for c in columns if c.present(version)]
    schema = ", ".join(f"{c.name} {c.type}" for c in asked) + f", {VERSION} int"
    stored = spark.read.schema(schema).parquet(path)
    return stored.select(*[
        F.when(F.col(VERSION) < c.since, F.lit(c.default).cast(c.type)).otherwise(F.col(c.name)).alias(c.name)
        for c in asked
    ])
