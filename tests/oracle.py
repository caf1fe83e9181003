"""Side-by-side comparison of a Spark result with its SQL on the same files."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, bool) or value is None:
        return str(value)
    return f"{type(value).__name__}:{value}"


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def type_differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Columns whose declared types differ."""
    relation = con.sql(sql)
    wanted = dict(zip(relation.columns, [str(t) for t in relation.types]))
    found = {n: TYPES.get(t, t.upper()) for n, t in df.dtypes}
    return [f"{n}: {t} != {wanted.get(n)}" for n, t in sorted(found.items()) if t != wanted.get(n)]


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    found_columns, found = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    wanted_columns, wanted = rows_of([d[0] for d in result.description], result.fetchall())
    if found_columns != wanted_columns:
        return f"columns {found_columns} != {wanted_columns}"
    if found != wanted:
        extra, missing = found - wanted, wanted - found
        return (
            f"{sum(found.values())} rows against {sum(wanted.values())}; {sum(extra.values())} extra, "
            f"{sum(missing.values())} missing; e.g. {list(extra)[:2]} / {list(missing)[:2]}"
        )
    return None
