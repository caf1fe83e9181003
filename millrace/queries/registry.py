"""Registered queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The given tables of one scale folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(sql: str | None = None):
    """Register ``fn(tables)`` under its own name."""

    def add(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        SPARK[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add
