"""Kafka settings and the message form.

The connector is a separate jar; without it the options and the message value
can still be built and checked.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = "|"


def read_options(brokers: str, topic: str, starting: str = "earliest", ending: str = "latest", extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """A bounded read from the configured start to the end of the topic."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        "endingOffsets": ending,
        **(extra or {}),
    }


def write_options(brokers: str, topic: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic, **(extra or {})}


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("kafka").options(**options).load()


def to_kafka_value(df: DataFrame, separator: str = SEPARATOR) -> DataFrame:
    """One text column ``value``: all columns joined; nulls are skipped."""
    parts = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return df.select(F.concat_ws(separator, *parts).alias("value"))


def from_kafka_value(df: DataFrame, columns: list[str], separator: str = SEPARATOR) -> DataFrame:
    """Fields of a message value, as text."""
    pieces = F.split(F.col("value").cast("string"), f"\\Q{separator}\\E")
    return df.select(*[F.try_element_at(pieces, F.lit(i + 1)).alias(c) for i, c in enumerate(columns)])


def write_kafka(df: DataFrame, options: Mapping[str, str]) -> None:
    to_kafka_value(df).write.format("kafka").options(**options).save()
