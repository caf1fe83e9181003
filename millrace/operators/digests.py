"""Comparison of two tables by a tree of digests: only leaves that differ are read and joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import names
from millrace.operators.quality import cell_diff
from millrace.scratch import stage

#: Ranges of the first key column, and buckets of key hashes inside each.
RANGES, BUCKETS = 64, 64
_ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def split_points(df: DataFrame, column: str, ranges: int) -> list:
    """Ascending values that cut the column into about equal parts; one pass, no exchange of rows.  None for kinds without quantiles."""
    if not isinstance(df.schema[column].dataType, _ORDERED):
        return []
    shares = [F.lit(k / ranges) for k in range(1, ranges)]
    found = df.agg(F.percentile_approx(f"`{column}`", F.array(*shares), F.lit(100 * ranges))).first()[0] or []
    return sorted({v for v in found if v is not None and v == v})


def range_number(column: Column, points: Sequence) -> Column:
    """How many of ``points`` are not above the value, found by halving; null is in the first range."""
    if not points:
        return F.lit(0)

    def cut(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column >= F.lit(points[middle]), cut(middle + 1, high)).otherwise(cut(low, middle))

    return cut(0, len(points))


def _digest(columns: Sequence[str], seed: int) -> Column:
    """Sum of row hashes: the same for any order of the rows.  A null counts apart from every value."""
    cells = [c for name in columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)"))


def leaves(df: DataFrame, keys: Sequence[str], columns: Sequence[str], points: Sequence) -> DataFrame:
    """(part, bucket, rows, one, two): the digests of all leaves; every task adds up its own rows first."""
    first = range_number(F.col(f"`{keys[0]}`"), points)
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(BUCKETS))
    every = [*keys, *columns]
    return df.groupBy(first.alias("part"), bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), _digest(every, 1).alias("one"), _digest(every, 2).alias("two")
    )


def differing_leaves(source: DataFrame, target: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None) -> tuple[list[tuple[int, int]], list]:
    """([(part, bucket)], split points) of the leaves whose rows are not the same on both sides.

    At most ``RANGES`` * ``BUCKETS`` pairs reach the driver, however large the tables.
    """
    keys = names(key)
    compared = list(columns) if columns is not None else [c for c in source.columns if c not in keys]
    points = split_points(source, keys[0], RANGES)
    sides = [leaves(df, keys, compared, points).select("part", "bucket", F.struct("rows", "one", "two").alias(n)) for df, n in ((source, "s"), (target, "t"))]
    both = sides[0].join(sides[1], ["part", "bucket"], "full_outer").where(~F.col("s").eqNullSafe(F.col("t")))
    return sorted((r["part"], r["bucket"]) for r in both.select("part", "bucket").collect()), points


def in_leaves(df: DataFrame, keys: Sequence[str], found: Sequence[tuple[int, int]], points: Sequence) -> DataFrame:
    """The rows of the leaves ``found``; their key ranges are plain bounds, which reach the scan."""
    value = F.col(f"`{keys[0]}`")
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(BUCKETS))
    buckets: dict[int, list[int]] = {}
    for part, number in found:
        buckets.setdefault(part, []).append(number)
    test = F.lit(False)
    for part, numbers in buckets.items():
        inside = F.lit(True)
        if points and part > 0:
            inside = inside & (value >= F.lit(points[part - 1]))
        if points and part < len(points):
            above = value < F.lit(points[part])
            inside = inside & (above if part else above | value.isNull())
        test = test | (inside & bucket.isin(numbers))
    return df.where(test)


def tree_diff(source: DataFrame, target: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``quality.cell_diff``, from the leaves that differ alone.

    Each side is read once for its digests; equal leaves are neither read again
    nor joined.  The digest of a leaf is a row count and two sums of 64-bit
    hashes.  Repeated keys stop the job only in leaves that differ.
    """
    keys = names(key)
    compared = list(columns) if columns is not None else [c for c in source.columns if c not in keys]
    found, points = differing_leaves(source, target, keys, compared)
    left, right = (in_leaves(df.select(*keys, *compared), keys, found, points) for df in (source, target))
    return cell_diff(left, right, keys, compared)


def tree_missing(source: DataFrame, target: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that only one side has, from the leaves whose keys differ."""
    from millrace.operators.quality import missing_keys

    keys = names(key)
    found, points = differing_leaves(source, target, keys, [])
    return missing_keys(*(stage(in_leaves(df.select(*keys), keys, found, points), "tree-keys") for df in (source, target)), keys)


def trees_equal(source: DataFrame, target: DataFrame, key: str | Sequence[str]) -> bool:
    """Whether both hold the same rows, by digests alone."""
    return not differing_leaves(source, target, key)[0]
