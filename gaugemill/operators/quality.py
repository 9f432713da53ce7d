"""Data-quality checks; each gives (check_name, table_name, key_name, n_bad) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.constants import STORED_TYPE
from gaugemill.functions import json_docs


def _row(check: str, table: str, key: str, n_bad: Column) -> list[Column]:
    return [
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(key).alias("key_name"),
        F.coalesce(n_bad, F.lit(0)).cast("long").alias("n_bad"),
    ]


def unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; keys with a NULL never collide."""
    groups = df.dropna(subset=list(keys)).groupBy(*keys).count().filter(F.col("count") > 1)
    return groups.agg(F.count(F.lit(1)).alias("n")).select(
        *_row("unique", table, ",".join(keys), F.col("n"))
    )


def foreign_key(
    child: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose key has no parent.

    Child rows are first counted per key, so a hot key is one row in the join.
    """
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_key).alias(key)).distinct()
    orphans = counted.join(parents, key, "left_anti")
    return orphans.agg(F.sum("n").alias("n")).select(*_row("foreign_key", table, key, F.col("n")))


def _per_column(df: DataFrame, check: str, table: str, bad: dict[str, Column]) -> DataFrame:
    """One row per column from a single pass."""
    counted = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in bad.items()])
    entries = F.array(
        *[F.struct(F.lit(k).alias("key_name"), F.col(k).alias("n_bad")) for k in bad]
    )
    return counted.select(F.inline(entries)).select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "key_name", "n_bad"
    )


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return _per_column(df, "not_null", table, {c: F.col(c).isNull() for c in columns})


def numeric_range(
    df: DataFrame, table: str, columns: Sequence[str], type_name: str = STORED_TYPE
) -> DataFrame:
    """Values that the stored decimal type cannot hold."""
    bad = {c: F.col(c).isNotNull() & F.col(c).try_cast(type_name).isNull() for c in columns}
    return _per_column(df, "numeric_range", table, bad)


def json_documents(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Texts that are no JSON document (NaN and Infinity are none)."""
    bad = {c: F.col(c).isNotNull() & ~json_docs.is_json(F.col(c)) for c in columns}
    return _per_column(df, "json", table, bad)


def finite(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Floating-point values that JSON cannot hold."""
    def not_finite(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.isnan(value) | F.abs(value).eqNullSafe(F.lit(float("inf")))

    return _per_column(df, "finite", table, {c: not_finite(c) for c in columns})
