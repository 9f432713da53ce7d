"""Ids and labels of everything ever appended to a table, kept apart from its rows.

A ledger is a folder of small entries beside the table.  An append is *planned* (label,
first id, number of rows, earliest day) before it happens and *done* after it; the rows it
is about to append are staged in between, so that any later job can finish what died half
way.  Ids rise for ever, and a label is known for ever, whatever retention removes.

Entries are folded into one file every FOLD_AFTER entries.  A fold writes the new file
before it removes what it read, and readers take an entry once however often it is written.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugemill.session import folders, remove_folder

ENTRY = "label string, first long, n long, lowest_day date, done boolean"
FOLD_AFTER = 64


def stored(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """A stored table, or None where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class Entry:
    label: str
    first: int
    n: int
    lowest_day: date | None
    done: bool


class Ledger:
    """The ledger of the table at ``table_path``."""

    def __init__(self, spark: SparkSession, table_path: str):
        self.spark = spark
        self.path = f"{table_path}_jobs/ledger"

    def entries(self) -> DataFrame:
        """One row per label: what was planned, and whether it is done."""
        found = stored(self.spark, f"{self.path}/*", ENTRY)
        if found is None:
            found = self.spark.createDataFrame([], ENTRY)
        return found.groupBy("label").agg(
            F.min("first").alias("first"), F.max("n").alias("n"),
            F.min("lowest_day").alias("lowest_day"), F.max("done").alias("done"),
        )

    def find(self, label: str) -> Entry | None:
        row = self.entries().filter(F.col("label") == label).first()
        return Entry(**row.asDict()) if row else None

    def unfinished(self) -> list[Entry]:
        """Planned appends that are not done, in order; one writer leaves at most a few."""
        rows = self.entries().filter("not done").orderBy("first", "label").collect()
        return [Entry(**r.asDict()) for r in rows]

    def high_water(self) -> int:
        """Highest id ever planned, 0 for a new table."""
        top = F.max(F.col("first") + F.col("n"))
        return self.entries().agg(F.coalesce(top, F.lit(0))).first()[0]

    def lowest_day_after(self, first: int) -> date | None:
        """Earliest day among appends whose ids follow ``first``."""
        return self.entries().filter((F.col("first") >= first) & (F.col("n") > 0)).agg(
            F.min("lowest_day")
        ).first()[0]

    def plan(self, label: str, first: int, n: int, lowest_day: date | None) -> Entry:
        entry = Entry(label, first, n, lowest_day, False)
        self._write(entry)
        return entry

    def finish(self, entry: Entry) -> None:
        self._write(Entry(entry.label, entry.first, entry.n, entry.lowest_day, True))
        if len(folders(self.spark, self.path)) > FOLD_AFTER:
            self.fold()

    def fold(self) -> None:
        read = folders(self.spark, self.path)
        self.entries().coalesce(1).write.parquet(f"{self.path}/fold-{uuid.uuid4().hex}")
        for folder in read:
            remove_folder(self.spark, folder)

    def _write(self, entry: Entry) -> None:
        name = hashlib.sha256(entry.label.encode()).hexdigest()
        row = self.spark.createDataFrame(
            [(entry.label, entry.first, entry.n, entry.lowest_day, entry.done)], ENTRY
        )
        state = "done" if entry.done else "planned"
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{state}-{name}")
