"""Aggregates, pivots and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import match_keys, names
from millrace.operators.windows import first_per_group
from millrace.scratch import stage

def with_pages(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], page_rows: int, name: str = "part") -> DataFrame:
    """Number the pages of each group: ``floor((rank - 1) / page_rows)`` by ``order_by``.

    The same at every size: page 0 holds the first ``page_rows`` rows of the
    sorted group, page 1 the next ones.  The rows are range partitioned by group
    and order, with a running number so that equal rows of a hot group spread as
    well; each bucket is ranked on its own and shifted by what the buckets before
    it hold of the same group, so no group meets in one task.
    """
    place = F.monotonically_increasing_id().alias("_place")
    order = [F.col(k).asc_nulls_first() for k in keys] + list(order_by)
    ranged = df.select("*", place).repartitionByRange(*order, F.col("_place"))
    ranged = stage(ranged.withColumn("_bucket", F.spark_partition_id()).drop("_place"), "pages")
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_bucket", *keys).agg(F.count(F.lit(1)).alias("_n"))
    shifts = sizes.withColumn("_shift", F.sum("_n").over(earlier)).where("_shift IS NOT NULL").drop("_n")
    # a row for each group that a bucket's edge cuts, at most
    shifts = stage(shifts, "page-shifts")
    inside = F.row_number().over(Window.partitionBy("_bucket", *keys).orderBy(*order_by))
    ranked = match_keys(ranged.withColumn("_rank", inside), shifts, ["_bucket", *keys], "left")
    rank = F.col("_rank") + F.coalesce("_shift", F.lit(0)) - 1
    return ranked.select(*df.columns, F.floor(rank / page_rows).cast("bigint").alias(name))


def pivot_concat(
    df: DataFrame,
    index: str | Sequence[str],
    column: str,
    values: str,
    pivot_values: Sequence | None = None,
    *,
    page_rows: int,
) -> DataFrame:
    """Pivot whose cells hold all values, sorted and joined by commas.

    ``part`` numbers the pieces of ``page_rows`` values of a cell; joining them in
    order gives the whole cell.  Null values are left out.  Without named pivot
    values an empty input comes back unchanged, and more distinct values than
    ``spark.sql.pivotMaxValues`` (10,000) stop the job, as each is a column.
    """
    if pivot_values is None and df.isEmpty():
        return df
    index = names(index)
    slim = df.select(*dict.fromkeys([*index, column, values]))
    paged = with_pages(slim, [*index, column], [F.col(values).asc_nulls_last()], page_rows)
    cell = F.array_join(F.transform(F.sort_array(F.collect_list(values)), lambda v: v.cast("string")), ",")
    grouped = paged.groupBy(*index, "part")
    return grouped.pivot(column, list(pivot_values) if pivot_values is not None else None).agg(cell)


def pivot_table(
    df: DataFrame, index: str | Sequence[str], column: str, values: str, function: str, pivot_values: Sequence | None = None
) -> DataFrame:
    """Pivot with a named aggregate; name the pivot values to save a pass.

    Without them an empty input comes back unchanged, and more distinct values
    than ``spark.sql.pivotMaxValues`` (10,000) stop the job, as each is a column.
    """
    if pivot_values is None and df.isEmpty():
        return df
    grouped = df.groupBy(*names(index)).pivot(column, list(pivot_values) if pivot_values is not None else None)
    return grouped.agg({values: function})


def pack_json(
    df: DataFrame, keys: str | Sequence[str], fields: Sequence[str], name: str, *, page_rows: int
) -> DataFrame:
    """Child rows of a key as JSON array texts, sorted by ``fields`` in order.

    ``part`` numbers the pieces of ``page_rows`` rows of a group; their arrays in
    order make up the whole one.
    """
    keys = names(keys)
    slim = df.select(*dict.fromkeys([*keys, *fields]))
    paged = with_pages(slim, keys, [F.col(f).asc_nulls_first() for f in fields], page_rows)
    packed = F.to_json(F.sort_array(F.collect_list(F.struct(*fields))))
    return paged.groupBy(*keys, "part").agg(packed.alias(name))


def max_key(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias(f"max_{column}"))


def bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value, cut to whole numbers."""
    return df.agg(
        F.min(column).cast("bigint").alias("lower_bound"), F.max(column).cast("bigint").alias("upper_bound")
    )


def remove_duplicates(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_duplicates(df: DataFrame, subset: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """One row per subset value: the first in ``order_by``."""
    return first_per_group(df, subset, order_by)


def group_distinct(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def phase_counts(df: DataFrame, phase: str | Column, name: str = "phase") -> DataFrame:
    """Row count of every phase in one aggregate."""
    label = F.col(phase) if isinstance(phase, str) else phase
    return df.groupBy(label.alias(name)).agg(F.count(F.lit(1)).alias("rows"))
