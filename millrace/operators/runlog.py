"""Run log, service levels and black-out windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import names
from millrace.functions.constants import FAILURE, NEVER_RAN, STARTED, SUCCESS

LOG_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("pipeline_id", "execution_id", "table_name", "load_type", "load_phase",
                                                "frequency_type", "job_status", "sla_met", "error_message")]
    + [T.StructField(n, T.TimestampNTZType()) for n in ("execution_start_dttm", "execution_end_dttm",
                                                        "business_order_from_dttm", "business_order_to_dttm", "logged_at")]
    # null means "not counted", not zero
    + [T.StructField(n, T.LongType()) for n in ("landing_count", "final_count", "processed_count")]
)


def log_rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    return spark.createDataFrame([[r.get(f.name) for f in LOG_SCHEMA.fields] for r in rows], LOG_SCHEMA)


def started(pipeline_id: str, execution_id: str, at: dt.datetime, **details) -> dict:
    return {"pipeline_id": pipeline_id, "execution_id": execution_id, "job_status": STARTED,
            "execution_start_dttm": at, "logged_at": at, **details}


def finished(start: dict, at: dt.datetime, error: str | None = None, **details) -> dict:
    return {**start, "job_status": FAILURE if error else SUCCESS, "error_message": error,
            "execution_end_dttm": at, "logged_at": at, **details}


def append_log(spark: SparkSession, rows: Sequence[dict], path: str) -> None:
    """Add states to the stored log; earlier ones stay as they are."""
    log_rows(spark, rows).coalesce(1).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def fetch_from(log: DataFrame, pipeline_id: str) -> dt.datetime:
    """Where the next increment of one pipeline begins."""
    found = last_success(log.filter(F.col("pipeline_id") == pipeline_id), "pipeline_id").first()
    return found["fetch_from"] if found else NEVER_RAN


def latest_runs(log: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """Last logged state of every run."""
    keys = names(keys)
    order = [c for c in names(order_by) if c not in keys]
    rest = [c for c in log.columns if c not in keys and c not in order]
    last = log.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return last.select(*[c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in log.columns])


def last_success(log: DataFrame, keys: str | Sequence[str], status: str = "job_status", start: str = "execution_start_dttm") -> DataFrame:
    """Start of the last successful run per key, 1900-01-01 when there is none."""
    found = F.max(F.when(F.col(status) == SUCCESS, F.col(start).cast("timestamp_ntz")))
    never = F.lit(str(NEVER_RAN)).cast("timestamp_ntz")
    return log.groupBy(*names(keys)).agg(F.coalesce(found, never).alias("fetch_from"))


def _seconds_of(text: Column) -> Column:
    parts = F.split(text, ":")
    return sum(parts.getItem(i).try_cast("int") * unit for i, unit in enumerate((3600, 60, 1)))


def sla_met(df: DataFrame, start: str, end: str, limit: str, name: str = "sla_met") -> DataFrame:
    """true when the run took less than ``hh:mm:ss``; "not applicable" without a limit."""
    took = (F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))) / 1e6
    none = F.coalesce(F.trim(F.col(limit)), F.lit("")) == ""
    verdict = F.when(took < _seconds_of(F.col(limit)), F.lit("true")).otherwise(F.lit("false"))
    return df.withColumn(name, F.when(none, F.lit("not applicable")).otherwise(verdict))


def ola_blocked(df: DataFrame, start: str, window: str, name: str = "blocked") -> DataFrame:
    """Does the start time of day lie inside ``hh:mm:ss-hh:mm:ss``, ends included."""
    ends = F.split(F.col(window), "-")
    clock = F.date_format(F.col(start), "HH:mm:ss.SSSSSS")
    begin = F.concat(F.trim(ends.getItem(0)), F.lit(".000000"))
    finish = F.concat(F.trim(F.try_element_at(ends, F.lit(2))), F.lit(".000000"))
    inside = clock.between(begin, finish)
    return df.withColumn(name, F.when(F.col(window).contains("-"), inside).otherwise(F.lit(False)))
