"""Catalogue registration."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.types import ddl_type, target_type


def ddl_types(columns: DataFrame, name: str = "ddl_type") -> DataFrame:
    """CREATE TABLE type of every column record."""
    length: Column = F.col("target_length").try_cast("int")
    precision: Column = F.col("target_precision").try_cast("int")
    return columns.withColumn(name, ddl_type(F.col("target_datatype"), length, precision))


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def table_ddl(name: str, columns: Iterable[tuple[str, str]], location: str, partition_col: str | None = None) -> str:
    """External Parquet table; the partition column is text."""
    listed = [(c, t) for c, t in columns if c != partition_col]
    if partition_col:
        listed.append((partition_col, "string"))
    body = ", ".join(f"`{c}` {t}" for c, t in listed)
    parts = f" PARTITIONED BY (`{partition_col}`)" if partition_col else ""
    return f"CREATE TABLE {_quoted(name)} ({body}) USING PARQUET{parts} LOCATION '{location}'"


def register_table(
    spark: SparkSession, name: str, columns: DataFrame | Iterable[Mapping], location: str, partition_col: str | None = None
) -> DataFrame:
    """Drop and create the table over files already written.

    ``columns`` is a frame with the schema or the inventory's column records.
    """
    if isinstance(columns, DataFrame):
        pairs = columns.dtypes
    else:
        ordered = sorted(columns, key=lambda r: int(r["sequence_number"]))
        pairs = [
            (r["target_column_name"], target_type(r["target_datatype"], r.get("target_length"), r.get("target_precision")))
            for r in ordered
        ]
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    spark.sql(table_ddl(name, pairs, location, partition_col))
    return spark.table(_quoted(name))


def repair_table(spark: SparkSession, name: str) -> None:
    """Make partition folders written since the last repair visible."""
    spark.catalog.recoverPartitions(_quoted(name))
