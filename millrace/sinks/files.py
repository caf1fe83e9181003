"""File sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import fs
from millrace.scratch import work_dir


def write_landing(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite a landing folder.  ``files`` merges small outputs; leave it out
    for large tables, where one file would mean one writing task."""
    (df.coalesce(files) if files else df).write.mode("overwrite").parquet(path)


def overwrite_via_temp(df: DataFrame, path: str, temp: str | None = None) -> str:
    """Overwrite a path that the frame itself reads.

    The result is stored completely under ``temp`` first; the final folder is
    then rewritten from there.  The temporary copy stays marked as complete only
    until that is done, so after a crash ``finish_overwrite`` knows what to do.
    """
    spark = df.sparkSession
    temp = temp or work_dir(spark, "overwrite")
    df.write.mode("overwrite").parquet(temp)
    finish_overwrite(spark, path, temp)
    return temp


def finish_overwrite(spark: SparkSession, path: str, temp: str) -> bool:
    """Copy a complete temporary result into place; False when there is none."""
    if not fs.committed(spark, temp):
        return False
    spark.read.parquet(temp).write.mode("overwrite").parquet(path)
    fs.release(spark, temp)
    return True


def write_partition(df: DataFrame, path: str, column: str, date: dt.date | str) -> None:
    """Write the rows as the ``column=<date>`` folder; a repeated run replaces that folder only."""
    dated = df.withColumn(column, F.lit(str(date))).write.partitionBy(column)
    dated.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_partitioned(spark: SparkSession, path: str, like: DataFrame, column: str) -> DataFrame:
    """Read back with the partition column as text instead of an inferred date."""
    schema = like.drop(column).schema.add(column, "string")
    return spark.read.schema(schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
