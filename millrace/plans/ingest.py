"""Configured ingestion: read, land, type, capture changes, store, register, log."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import match_keys
from millrace.operators import cdc
from millrace.operators.columns import error_records, split_rescued, typed_rescue, typed_select
from millrace.operators.filters import incremental_filter, incremental_predicate, moment_text
from millrace.operators.lineage import LineageLog, column_pairs
from millrace.operators.runlog import append_log, finished, started
from millrace.plans.config import Ingestion
from millrace.sinks import versions
from millrace.sinks.files import write_partition, finish_overwrite, overwrite_via_temp, write_landing
from millrace.sinks.tables import register_table, repair_table
from millrace.sources.files import read_any
from millrace.sources.jdbc import read_jdbc
from millrace.sources.targets import read_target


@dataclass
class RunResult:
    log: dict
    final_path: str
    written: bool


def layer_path(base: str, layer: str, table: str) -> str:
    return f"{base.rstrip('/')}/data/{layer}/{table}"


def source_query(spec: Ingestion, since: dt.datetime | None, until: dt.datetime) -> str:
    """The statement sent to a database source.

    A configured query may hold two ``{}`` for the window; without any earlier
    success it falls back to the plain column list.  A table gets its columns in
    sequence order and the change-time filter.
    """
    ordered = sorted(spec.columns, key=lambda c: int(c["sequence_number"]))
    listed = ", ".join(c["source_column_name"] for c in ordered)
    plain = f"select {listed} from {spec.source.get('source_table_name')}"
    query = spec.source.get("source_query")
    if query:
        if "{}" not in query:
            return query
        if since is None:
            return plain
        return query.format(moment_text(since), moment_text(until))
    if not spec.change_times:
        return plain
    dialect = spec.source.get("source_database_type", "")
    zone = spec.source.get("source_time_zone") or None
    return f"{plain} where {incremental_predicate(spec.change_times, since, until, dialect, zone)}"


def read_source(
    spark: SparkSession, spec: Ingestion, since: dt.datetime | None, until: dt.datetime, connection: Mapping | None = None
) -> DataFrame:
    if spec.source.get("source_type") == "database":
        part = spec.source.get("source_partition_col") or None
        return read_jdbc(
            spark, spec.source["source_database_type"], connection or {}, query=source_query(spec, since, until),
            partition_col=part,
        )
    path = f"{spec.source['source_file_path'].rstrip('/')}/{spec.source.get('source_file_name', '')}".rstrip("/")
    df = read_any(spark, path, spec.columns)
    return incremental_filter(df, spec.change_times, since, until) if spec.change_times else df


def capture(spec: Ingestion, target: DataFrame | None, typed: DataFrame, upsert_mode: str = "replace") -> DataFrame:
    """The change-capture style the record asks for."""
    if spec.load_type == "full":
        return typed
    if target is None:
        if spec.op_column in typed.columns:
            # nothing stored yet: deletions have no row to remove
            empty = typed.drop(spec.op_column, "rno").limit(0)
            return cdc.merge_by_indicator(empty, typed, spec.keys, spec.op_column)
        return cdc.first_load(typed)
    if spec.op_column:
        return cdc.merge_by_indicator(target, typed, spec.keys, spec.op_column)
    if spec.partition_col:
        return cdc.partition_snapshot(target, typed)
    if spec.keys:
        return cdc.upsert(target, typed, spec.keys, upsert_mode)
    return cdc.append(target, typed)


def in_blackout(ola: str, at: dt.datetime) -> bool:
    if "-" not in ola:
        return False
    begin, end = (dt.time.fromisoformat(part.strip()) for part in ola.split("-", 1))
    return begin <= at.time() <= end


def run_ingest(
    spark: SparkSession,
    spec: Ingestion,
    base: str,
    as_of: dt.datetime,
    since: dt.datetime | None = None,
    source: DataFrame | None = None,
    connection: Mapping | None = None,
    database: str | None = None,
    files: int | None = None,
    log_path: str | None = None,
    clock: Callable[[], float] = time.monotonic,
    errors: str | None = None,
    versioned: bool = False,
    lineage: LineageLog | None = None,
) -> RunResult:
    """Run one record.

    ``lineage`` gets an event for typing, one for the change capture and the
    closing one of the stored table; a run that fails or stores nothing adds none.

    A ``versioned`` final table is one of ``sinks.versions``: an increment writes
    only the files anew that hold one of its keys, and readers see the old version
    until the new one is complete.  It needs keys and no partition column.

    With ``errors``, rows with a value that does not fit its type are not stored
    with a null in its place: they go to the partition of ``as_of`` in the error
    table there, which ``read_latest_partition`` and ``exclude_quarantined`` read.
    Rows stored and rows in error together are the rows landed, or the run fails.

    The source is read once, into the landing layer; everything after works on
    the landed files.  An increment without rows changes no stored table.

    The log row's end is ``as_of`` plus the time the run took by ``clock``, which
    also decides on the service level.  With ``log_path`` the states are stored; a
    run that fails leaves its failure there before the error goes on.
    """
    begun = clock()
    log = started(
        spec.pipeline_id, f"{spec.pipeline_id}_{as_of:%Y%m%d%H%M%S%f}", as_of, table_name=spec.table,
        load_type=spec.load_type, business_order_from_dttm=since, business_order_to_dttm=as_of,
    )
    final = layer_path(base, "final", spec.table)

    def end(error: str | None = None, **counts: int) -> dict:
        took = clock() - begun
        row = finished(log, as_of + dt.timedelta(seconds=took), error=error, sla_met=within_sla(spec.sla, took), **counts)
        if log_path:
            append_log(spark, [row], log_path)
        return row

    if log_path:
        append_log(spark, [log], log_path)
    if in_blackout(spec.ola, as_of):
        return RunResult(end(f"start time lies in {spec.ola}"), final, False)
    try:
        counts = _load(spark, spec, base, as_of, since, source, connection, database, files, errors, versioned, lineage)
    except Exception as error:
        end(f"{type(error).__name__}: {error}")
        raise
    return RunResult(end(**counts), final, counts["landing_count"] > 0)


def within_sla(limit: str, seconds: float) -> str:
    """true when the run took less than ``hh:mm:ss``; "not applicable" without a limit."""
    if not limit.strip():
        return "not applicable"
    hours, minutes, rest = (int(part) for part in limit.split(":"))
    return "true" if seconds < hours * 3600 + minutes * 60 + rest else "false"


def _load(
    spark: SparkSession, spec: Ingestion, base: str, as_of: dt.datetime, since: dt.datetime | None, source: DataFrame | None,
    connection: Mapping | None, database: str | None, files: int | None, errors: str | None = None,
    versioned: bool = False, lineage: LineageLog | None = None,
) -> dict[str, int]:
    """Land, type, capture, store and register; the counts of landed and stored rows."""
    landing = layer_path(base, "landing", spec.table)
    raw = source if source is not None else read_source(spark, spec, since, as_of, connection)
    write_landing(raw, landing, files)
    stored_raw = spark.read.schema(raw.schema).parquet(landing)
    landed = stored_raw.count()
    if not landed:
        return {"landing_count": 0, "final_count": 0}

    keep = [spec.op_column] if spec.op_column else []
    if not errors:
        typed = typed_select(stored_raw, spec.columns, keep=keep)
        stored = _store(spark, spec, base, typed, as_of.date(), database, versioned)
        _record(lineage, spec, base, as_of, raw, typed)
        return {"landing_count": landed, "final_count": stored}
    good, bad = split_rescued(typed_rescue(stored_raw, spec.columns, keep=keep))
    wrong = Observation()
    records = error_records(bad, spec.table, spec.keys).observe(wrong, F.count(F.lit(1)).alias("rows"))
    write_partition(records, errors, "load_dt", as_of.date())
    processed = landed - wrong.get["rows"]
    if good.count() != processed:
        raise RuntimeError(f"{spec.table}: {landed} rows landed, but good and bad ones are not as many")
    stored = _store(spark, spec, base, good, as_of.date(), database, versioned)
    _record(lineage, spec, base, as_of, raw, good)
    return {"landing_count": landed, "processed_count": processed, "final_count": stored}


def _record(lineage: LineageLog | None, spec: Ingestion, base: str, at: dt.datetime, raw: DataFrame, typed: DataFrame) -> None:
    """The events of a run that stored its rows."""
    if lineage is None:
        return
    source = spec.source.get("source_table_name") or spec.source.get("source_file_path") or f"{spec.table}_source"
    typed_name, final = f"{spec.table}_typed", layer_path(base, "final", spec.table)
    named = {c["source_column_name"]: c["target_column_name"] for c in spec.columns if c["source_column_name"] != c["target_column_name"]}
    lineage.record(
        "typed_select", typed_name, at, source_tables=[source], selected_cols=raw.columns, final_df_cols=column_pairs(typed), renamed_cols=named,
        dropped_cols=sorted(set(raw.columns) - {c["source_column_name"] for c in spec.columns} - {spec.op_column}),
    )
    style = "merge_by_indicator" if spec.op_column else "partition_snapshot" if spec.partition_col else "upsert" if spec.keys else "append"
    lineage.record(
        "overwrite" if spec.load_type == "full" else style, spec.table, at, source_tables=[typed_name], key_cols=list(spec.keys),
        final_df_cols=column_pairs(typed.drop(*([spec.op_column] if spec.op_column else []))),
    )
    lineage.finish(typed, spec.table, final, at, sources=[source])


def _store(spark: SparkSession, spec: Ingestion, base: str, typed: DataFrame, day: dt.date, database: str | None, versioned: bool = False) -> int:
    """Capture the typed rows into the stored table; the number of rows written."""
    if versioned:
        return _store_version(spark, spec, layer_path(base, "final", spec.table), typed)
    final, temp = (layer_path(base, layer, spec.table) for layer in ("final", "tmp"))
    delta = spec.load_type != "full"
    if delta:
        # an earlier run may have stopped while it copied its result into place
        finish_overwrite(spark, final, temp)
    target = read_target(spark, final, spec.partition_col) if delta else None
    result = capture(spec, target, typed)

    stored = Observation()
    result = result.observe(stored, F.count(F.lit(1)).alias("rows"))
    if spec.partition_col:
        write_partition(result, final, spec.partition_col, day)
    elif target is not None:
        overwrite_via_temp(result, final, temp)
    else:
        result.write.mode("overwrite").parquet(final)

    _register(spark, spec, database, result, final)
    return stored.get["rows"]


def _store_version(spark: SparkSession, spec: Ingestion, path: str, typed: DataFrame) -> int:
    """Capture the typed rows as a new version; the number of rows it holds."""
    if not spec.keys or spec.partition_col:
        raise ValueError(f"{spec.table}: a versioned table needs keys and no partition column")
    if spec.load_type == "full" or versions.find_version(spark, path) is None:
        version = versions.write_version(capture(spec, None, typed), path, spec.keys)
    elif spec.op_column:
        version = versions.merge_version(spark, path, typed, spec.op_column)
    else:
        version = versions.upsert_version(spark, path, typed)
    return version.files(spark).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def _register(spark: SparkSession, spec: Ingestion, database: str | None, rows: DataFrame, path: str) -> None:
    if database:
        register_table(spark, f"{database}.{spec.table}", rows, path, spec.partition_col)
        if spec.partition_col:
            repair_table(spark, f"{database}.{spec.table}")


def day_windows(start: dt.datetime, end: dt.datetime) -> list[tuple[dt.datetime, dt.datetime]]:
    """One window per calendar day, from the start or midnight up to the next midnight, which belongs to the next window.

    The last window ends at ``end`` and holds it.
    """
    days = (end.date() - start.date()).days + 1
    midnights = [dt.datetime.combine(start.date() + dt.timedelta(days=i), dt.time()) for i in range(1, days)]
    return list(zip([start, *midnights], [*midnights, end]))


def backfill(
    spark: SparkSession,
    spec: Ingestion,
    base: str,
    start: dt.datetime,
    end: dt.datetime,
    source: DataFrame | None = None,
    connection: Mapping | None = None,
    database: str | None = None,
    files: int | None = None,
    log_path: str | None = None,
    clock: Callable[[], float] = time.monotonic,
) -> list[RunResult]:
    """Run one record for every day from ``start`` to ``end``; the stored table is that of one run after the other.

    The source is read, landed and typed once for all days.  Dated partitions
    are written in one job; merges apply the last day's rows of every key, which
    is what remains of one merge per day.  Each day has its log row; ``final_count``
    is known for a day's own partition, or after the last merge.
    """
    begun = clock()
    windows = day_windows(start, end)
    # the moment a day's run stands for: its last one
    moments = [until if until == end else until - dt.timedelta(microseconds=1) for _, until in windows]
    open_days = [not in_blackout(spec.ola, at) for at in moments]
    logs = [
        started(
            spec.pipeline_id, f"{spec.pipeline_id}_{at:%Y%m%d%H%M%S%f}", at, table_name=spec.table,
            load_type=spec.load_type, business_order_from_dttm=since, business_order_to_dttm=until,
        )
        for (since, until), at in zip(windows, moments)
    ]
    final = layer_path(base, "final", spec.table)
    if log_path:
        append_log(spark, logs, log_path)
    days = [at.date() for at, is_open in zip(moments, open_days) if is_open]
    try:
        raw = source if source is not None else read_source(spark, spec, start, end, connection)
        counts = _load_days(spark, spec, base, raw, start, end, days, database, files) if days else {}
    except Exception as error:
        if log_path:
            took = dt.timedelta(seconds=clock() - begun)
            append_log(spark, [finished(log, at + took, error=f"{type(error).__name__}: {error}") for log, at in zip(logs, moments)], log_path)
        raise
    took = clock() - begun
    results = []
    for log, at, is_open in zip(logs, moments, open_days):
        found = counts.get(at.date(), {"landing_count": 0, "final_count": 0}) if is_open else {}
        error = None if is_open else f"start time lies in {spec.ola}"
        row = finished(log, at + dt.timedelta(seconds=took), error=error, sla_met=within_sla(spec.sla, took), **found)
        results.append(RunResult(row, final, found.get("landing_count", 0) > 0))
    if log_path:
        append_log(spark, [r.log for r in results], log_path)
    return results


#: Day of a row in a backfill; no column of a source has this name.
DAY = "_backfill_day"


def with_days(raw: DataFrame, spec: Ingestion, start: dt.datetime, end: dt.datetime, days: list[dt.date]) -> DataFrame:
    """The rows once for every day on which one of their change times lies; without change times for every day."""
    wanted = F.array(*[F.lit(d) for d in days])
    if not spec.change_times:
        return raw.withColumn(DAY, F.explode(wanted))
    kinds = dict(raw.dtypes)
    found = []
    for c in spec.change_times:
        kind = kinds[c] if kinds[c].startswith("timestamp") else "timestamp"
        value = F.col(f"`{c}`").cast(kind)
        inside = value.between(F.lit(str(start)).cast(kind), F.lit(str(end)).cast(kind))
        found.append(F.when(inside, value.cast("date")))
    return raw.withColumn(DAY, F.explode(F.array_intersect(F.array(*found), wanted)))


def last_per_key(rows: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """All rows of the last day on which their key occurs."""
    last = rows.groupBy(*keys).agg(F.max(day).alias("_last"))
    return match_keys(rows, last, keys, "inner").where(F.col(day) == F.col("_last")).drop("_last")


def _load_days(
    spark: SparkSession, spec: Ingestion, base: str, raw: DataFrame, start: dt.datetime, end: dt.datetime, days: list[dt.date],
    database: str | None, files: int | None,
) -> dict[dt.date, dict]:
    """Land, type and store all days at once; counts of landed and stored rows by day."""
    landing, final = (layer_path(base, layer, spec.table) for layer in ("landing", "final"))
    dated = with_days(raw, spec, start, end, days)
    write_landing(dated, landing, files)
    stored = spark.read.schema(dated.schema).parquet(landing)
    landed = {r[DAY]: r["count"] for r in stored.groupBy(DAY).count().collect()}
    if not landed:
        return {}
    typed = typed_select(stored, spec.columns, keep=[*([spec.op_column] if spec.op_column else []), DAY])
    if spec.partition_col and not spec.op_column and spec.load_type != "full":
        # an oversized day is split over several tasks, small ones share one
        rows = typed.withColumn(spec.partition_col, F.col(DAY).cast("string")).drop(DAY).hint("rebalance", spec.partition_col)
        rows.write.partitionBy(spec.partition_col).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(final)
        _register(spark, spec, database, rows.drop(spec.partition_col), final)
        return {day: {"landing_count": n, "final_count": n} for day, n in landed.items()}
    last = max(landed)
    if spec.load_type == "full":
        typed = typed.where(F.col(DAY) == F.lit(last))
    elif spec.op_column:
        typed = last_per_key(typed.where(F.col(spec.op_column).isNotNull()), spec.keys, DAY)
    elif spec.keys:
        typed = last_per_key(typed, spec.keys, DAY)
    count = _store(spark, spec, base, typed.drop(DAY), last, database)
    return {day: {"landing_count": n, "final_count": count if day == last else None} for day, n in landed.items()}
