"""Stored targets and their dated partitions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import fs


def read_target(spark: SparkSession, path: str, partition_col: str | None = None) -> DataFrame | None:
    """The current target without its partition column, or None before the first load."""
    if not fs.has_data(spark, path):
        return None
    df = spark.read.parquet(path)
    return df.drop(partition_col) if partition_col else df


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the ``column=value`` folders, from the listing alone."""
    prefix = f"{column}="
    return sorted(n[len(prefix):] for n in fs.children(spark, path) if n.startswith(prefix))


def read_latest_partition(spark: SparkSession, path: str, column: str) -> DataFrame | None:
    """Rows of the newest dated partition; only that folder is listed and read."""
    values = [v for v in partition_values(spark, path, column) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", v)]
    if not values:
        return None
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/{column}={values[-1]}")


def latest_dated_files(spark: SparkSession, path: str) -> list[str]:
    """Files whose name carries the newest eight-digit date."""
    dated = [(m.group(), n) for n in fs.children(spark, path) if (m := re.search(r"(?<!\d)\d{8}(?!\d)", n))]
    newest = max((d for d, _ in dated), default=None)
    return [f"{path.rstrip('/')}/{n}" for d, n in dated if d == newest]


def export_catalog(
    spark: SparkSession, database: str, out: str, casts: Mapping[str, str] | None = None, prefix: str = ""
) -> list[str]:
    """Write every table of a catalogue database as Parquet and return the paths.

    ``casts`` names columns with an ambiguous type and the type to store.
    """
    written = []
    for table in sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary):
        if not table.startswith(prefix):
            continue
        df = spark.table(f"`{database}`.`{table}`")
        fixed = {c: F.col(f"`{c}`").cast(t) for c, t in (casts or {}).items() if c in df.columns}
        df.withColumns(fixed).write.mode("overwrite").parquet(f"{out.rstrip('/')}/{table}")
        written.append(f"{out.rstrip('/')}/{table}")
    return written
