"""Ranking and per-group values without moving a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import match_keys, names
from millrace.scratch import stage


def placed(df: DataFrame, order_by: Sequence[str | Column], label: str) -> DataFrame:
    """The range partitioned rows, sorted and staged with their bucket and their place in it."""
    # the upper bits number the partition, the lower ones its rows in order
    running = F.monotonically_increasing_id()
    places = {"_bucket": F.shiftright(running, 33), "_place": running.bitwiseAND(F.lit((1 << 33) - 1))}
    return stage(df.sortWithinPartitions(*order_by).withColumns(places), label, compression="zstd")


def shifted(rows: DataFrame, counted: Column | None = None) -> DataFrame:
    """``placed`` rows with ``_shift``, the number of rows (``counted`` ones, if given) in the buckets before theirs.

    The shifts, one row per bucket, are stored: their size is known before the
    join, which so needs no exchange of the rows.
    """
    sizes = rows.groupBy("_bucket").agg(F.count_if(F.lit(True) if counted is None else counted).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stage(sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")), "shifts")
    return rows.join(shifts, "_bucket")


def number_rows(
    df: DataFrame, order_by: str | Sequence[str], name: str, start: int | Column = 0, buckets: int | None = None, ranged: bool = False
) -> DataFrame:
    """Global ``row_number`` over ``order_by``, which must identify a row.

    The rows are range partitioned, sorted and staged with their bucket and their
    place in it, so one exchange numbers them and a sort may spill; each bucket is
    shifted by the sizes of the buckets before it.  Only those sizes (one row per
    bucket) meet in a single task.  Without ``buckets`` adaptive execution puts
    small ones together by their measured size.  ``ranged`` says that the rows
    come range partitioned by ``order_by``.
    """
    keys = names(order_by)
    if not ranged:
        df = df.repartitionByRange(buckets, *keys) if buckets else df.repartitionByRange(*keys)
    numbered = shifted(placed(df, keys, "numbered"))
    first = F.lit(start) if isinstance(start, int) else start
    return numbered.select(*df.columns, (F.col("_place") + 1 + F.col("_shift") + first).cast("bigint").alias(name))


def number_keys(df: DataFrame, key: str | Sequence[str], name: str, start: int | Column = 0, buckets=None) -> DataFrame:
    """Distinct keys with their dense rank plus ``start``."""
    return number_rows(df.select(*names(key)).distinct(), key, name, start, buckets)


def assign_sequence(
    df: DataFrame, key: str | Sequence[str], name: str, start: int | Column = 0, buckets: int | None = None
) -> DataFrame:
    """Surrogate numbers: rows with the same key share one, in key order.

    Equal to ``dense_rank() over (order by key) + start``; the rows themselves
    are only joined to their key's number.
    """
    numbers = number_keys(df, key, name, start, buckets)
    return match_keys(df.drop(name), numbers, key, "inner")


def first_per_group(df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """First row per key in ``order_by``, as an aggregate so that every task
    reduces its own rows before the shuffle.  Columns outside the order break
    remaining ties, so the survivor never depends on the layout."""
    keys, order = names(keys), names(order_by)
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in order if c not in keys]
    row = F.struct(*ordered, *[c for c in rest if c not in ordered])
    best = df.groupBy(*keys).agg(F.min(row).alias("_row"))
    return best.select(*[c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def min_over(df: DataFrame, keys: str | Sequence[str], column: str, name: str) -> DataFrame:
    """``min(column) over (partition by keys)`` as aggregate plus join, so a hot
    group stays spread over many tasks."""
    least = df.groupBy(*names(keys)).agg(F.min(column).alias(name))
    return match_keys(df, least, keys, "left")
