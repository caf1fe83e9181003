"""Row selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import match_keys, names
from millrace.functions.constants import NEVER_RAN, OPEN_END
from millrace.operators.columns import any_of


def select_rows(df: DataFrame, condition: str | Column) -> DataFrame:
    return df.filter(condition)


def incremental_filter(
    df: DataFrame, columns: str | Sequence[str], since: dt.datetime | None, until: dt.datetime, closed: bool = True
) -> DataFrame:
    """Rows whose change time lies in ``[since, until]`` in any of the columns.

    Both ends are inclusive; without ``closed`` the upper one is not, as in
    windows that follow one another.  ``since`` is the last successful start, or
    None when the pipeline never ran.
    """
    start = since or NEVER_RAN
    kinds = dict(df.dtypes)
    tests = []
    for c in names(columns):
        kind = kinds[c] if kinds[c].startswith("timestamp") else "timestamp"
        last = F.lit(str(until)).cast(kind)
        tests.append((F.col(c) >= F.lit(str(start)).cast(kind)) & ((F.col(c) <= last) if closed else (F.col(c) < last)))
    return df.filter(any_of(tests))


# databases that take standard timestamp literals and zone conversion; the others compare plain texts
STANDARD_TIMES = ("oracle", "postgres", "db2")


def incremental_predicate(
    columns: Sequence[str], since: dt.datetime | None, until: dt.datetime, dialect: str = "", time_zone: str | None = None,
    closed: bool = True,
) -> str:
    """The same test as SQL text for a database that filters before sending.

    ``time_zone`` names the zone in which ``since`` and ``until`` are meant, if the
    database keeps zoned times.  Parts of a second are written where there are any.
    """
    standard = dialect.lower() in STANDARD_TIMES
    if time_zone and not standard:
        raise ValueError(f"no zone conversion known for {dialect or 'this database'}")
    first, last = (f"{'TIMESTAMP ' if standard else ''}'{moment_text(t)}'" for t in (since or NEVER_RAN, until))
    tests = []
    for column in columns:
        moment = f"({column} AT TIME ZONE '{time_zone}')" if time_zone else column
        tests.append(f"({moment} >= {first} AND {moment} {'<=' if closed else '<'} {last})")
    return " OR ".join(tests)


def moment_text(moment: dt.datetime) -> str:
    """Date and time; microseconds only where there are any."""
    return moment.strftime("%Y-%m-%d %H:%M:%S.%f" if moment.microsecond else "%Y-%m-%d %H:%M:%S")


def current_rows(df: DataFrame, end: str = "end_dt", open_end: dt.date = OPEN_END) -> DataFrame:
    return df.filter(F.col(end) == F.lit(open_end))


def history_rows(df: DataFrame, end: str = "end_dt", open_end: dt.date = OPEN_END) -> DataFrame:
    return df.filter(F.col(end) != F.lit(open_end))


def active_published(df: DataFrame) -> DataFrame:
    return df.filter((F.col("active").cast("string") == "true") & (F.col("status") == "published"))


def delete_by_key(df: DataFrame, column: str, values: Iterable | DataFrame) -> DataFrame:
    """Rows whose key is not among the values; null keys stay."""
    if not isinstance(values, DataFrame):
        kind = dict(df.dtypes)[column]
        values = df.sparkSession.createDataFrame([(v,) for v in values], f"`{column}` {kind}")
    gone = values.select(values.columns[0]).distinct().toDF(column)
    return match_keys(df, gone, column, "left_anti", nulls_match=False)
