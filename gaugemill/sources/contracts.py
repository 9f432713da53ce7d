"""Schema contracts: the columns a job needs must exist before it runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def probe(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns with no rows; an unknown column fails at analysis."""
    return df.select(*columns).limit(0)


def differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """Missing columns and columns of another type, by name."""
    present = {f.name: f.dataType for f in df.schema.fields}
    found = []
    for field in expected.fields:
        if field.name not in present:
            found.append(f"{field.name}: missing")
        elif present[field.name] != field.dataType:
            found.append(
                f"{field.name}: {present[field.name].simpleString()}"
                f" instead of {field.dataType.simpleString()}"
            )
    return found


def require(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The relation itself, or an error that lists what is wrong with it."""
    found = differences(df, expected)
    if found:
        raise ValueError("schema contract broken: " + "; ".join(found))
    return df


def column_report(df: DataFrame, table: str) -> DataFrame:
    """How many rows each column fills: (table_name, column_name, n_rows, n_filled)."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(c)).alias(c) for c in df.columns],
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_filled")) for c in df.columns]
    )
    return counted.select("_rows", F.inline(entries)).select(
        F.lit(table).alias("table_name"), "column_name", F.col("_rows").alias("n_rows"), "n_filled"
    )
