"""Sorting, sampling and set operators.

Copies are collapsed (or counted) before rows are exchanged, so a row that
makes up much of a table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import names
from millrace.functions.hashing import tagged


# rows that a task holds at most while it looks for copies
TASK_ROWS = 500_000


def distinct_rows(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df.distinct()`` whose tasks hold about ``task_rows`` rows at every size.

    A pass before counts the rows and keeps a sketch of frequent ones.  Tables of
    more than ``task_rows`` rows are dealt to as many tasks as their rows ask for;
    rows with so many copies that these alone would fill a task go apart, where
    every task reduces its own copies first.
    """
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    rows, likely = df.select(digest.alias("h")).agg(F.count(F.lit(1)), F.expr("approx_top_k(h, 1000, 16000)")).first()
    if rows <= task_rows:
        return df.distinct()
    tasks = max(-(-rows // task_rows), df.sparkSession.sparkContext.defaultParallelism)
    hot = [i["item"] for i in likely if i["item"] is not None and i["count"] > rows // tasks]
    spread = df.where(~digest.isin(hot)) if hot else df
    spread = spread.repartition(tasks, *[F.col(f"`{c}`") for c in df.columns]).distinct()
    return spread.unionByName(df.where(digest.isin(hot)).distinct()) if hot else spread


def sort_rows(df: DataFrame, keys: str | Sequence[str], descending: bool = False) -> DataFrame:
    """Global sort.  The other columns break ties, so that the rows of a frequent
    key are spread over several sorted partitions."""
    keys = names(keys)
    kinds = dict(df.dtypes)
    ties = [c for c in df.columns if c not in keys and not kinds[c].startswith("map")]
    order = [F.desc(k) if descending else F.asc(k) for k in keys]
    return df.orderBy(*order, *[F.col(f"`{c}`") for c in ties])


def sample_keys(df: DataFrame, columns: str | Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` distinct keys, the same ones on every run with the same seed."""
    keys = df.select(*names(columns)).distinct()
    order = F.md5(F.concat_ws(",", F.lit(str(seed)), *[tagged(c) for c in keys.columns]))
    return keys.orderBy(order, *keys.columns).limit(n)


def presence(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of both sides with the flags ``_in_left`` and ``_in_right``.

    One aggregate over the union: every task reduces its copies first, a single
    exchange serves both sides, and rows compare null-safely.
    """
    yes, no = F.lit(True), F.lit(False)
    both = left.withColumns({"_in_left": yes, "_in_right": no}).unionByName(
        right.select(*left.columns).withColumns({"_in_left": no, "_in_right": yes})
    )
    return both.groupBy(*left.columns).agg(F.max("_in_left").alias("_in_left"), F.max("_in_right").alias("_in_right"))


def complement(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct left rows that do not occur on the right; columns match by name."""
    return presence(left, right).filter(F.col("_in_left") & ~F.col("_in_right")).select(*left.columns)


def common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    return presence(left, right).filter(F.col("_in_left") & F.col("_in_right")).select(*left.columns)


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """By position, keeping duplicates."""
    return left.union(right)


def union_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right)


def union_many(frames: Sequence[DataFrame], load_date: Column | None = None, name: str = "load_dt") -> DataFrame:
    combined = reduce(lambda a, b: a.unionByName(b), frames)
    return combined if load_date is None else combined.withColumn(name, load_date)


def _signed_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    tagged_rows = left.withColumn("_sign", F.lit(1)).unionByName(
        right.select(*left.columns).withColumn("_sign", F.lit(-1))
    )
    return tagged_rows.groupBy(*left.columns).agg(F.sum("_sign").alias("_balance")).filter(F.col("_balance") != 0)


def two_way_minus(left: DataFrame, right: DataFrame, left_name: str = "source", right_name: str = "target") -> DataFrame:
    """Rows that one side has more often than the other, with the surplus."""
    balance = F.col("_balance")
    return _signed_counts(left, right).select(
        F.when(balance > 0, F.lit(left_name)).otherwise(F.lit(right_name)).alias("only_in"),
        F.abs(balance).cast("bigint").alias("copies"),
        *left.columns,
    )


def frames_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: are both frames the same multiset of rows, and how many differ."""
    if set(left.columns) != set(right.columns):
        raise ValueError(f"columns differ: {sorted(left.columns)} and {sorted(right.columns)}")
    diff = _signed_counts(left, right)
    only_left = F.coalesce(F.sum(F.greatest("_balance", F.lit(0))), F.lit(0)).cast("bigint")
    only_right = F.coalesce(F.sum(F.greatest(-F.col("_balance"), F.lit(0))), F.lit(0)).cast("bigint")
    return diff.agg(only_left.alias("only_left"), only_right.alias("only_right")).select(
        ((F.col("only_left") == 0) & (F.col("only_right") == 0)).alias("is_equal"), "only_left", "only_right"
    )
