"""Side-by-side comparison of a query with its SQL, independent of row order."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, date):
        return value
    return value


def sortable(row):
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=sortable)


KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql, check_types: bool = True) -> list[str]:
    got_names, got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    described = [(c[0], str(c[1])) for c in cursor.description]
    want_names, want = rows_of([c for c, _ in described], cursor.fetchall())
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    out = []
    if check_types:
        kinds = dict(described)
        for name, kind in df.dtypes:
            if KINDS.get(kind) != kinds[name]:
                out.append(f"type of {name}: {kind} vs {kinds[name]}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, first {got_names}: {bad[0][0]} != {bad[0][1]}")
    return out
