"""Sources, sinks, ingestion runs and the change stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from conftest import rows

from millrace import fs, scratch
from millrace.operators import runlog
from millrace.operators.runlog import log_rows
from millrace.plans.config import Ingestion, as_list, environment_settings
from millrace.plans.ingest import backfill, capture, run_ingest, source_query
from millrace.sinks import files as sink
from millrace.sinks import tables
from millrace.sources import files as src
from millrace.sources import jdbc, kafka, targets
from millrace.streaming import changes as stream


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("sep", [",", ";", "|", "\t"])
def test_sniff_finds_separator_and_header(sep):
    lines = [sep.join(r) for r in [("id", "name", "amount"), ("1", "ann", "10.5"), ("2", "bob", "7.25"), ("3", "cy", "1.0")]]
    assert src.sniff(lines) == (sep, True)
    assert src.sniff(lines[1:])[0] == sep


def test_read_delimited(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id;name;amount\n1;ann;10.5\n2;bob;7.25\n3;cy;\n")
    df = src.read_any(spark, path)
    assert df.dtypes == [("id", "int"), ("name", "string"), ("amount", "double")]
    assert rows(df) == [(1, "ann", 10.5), (2, "bob", 7.25), (3, "cy", None)]


def test_files_that_disagree_are_refused(spark, tmp_path):
    write(tmp_path / "d" / "a.csv", "id;name;amount\n1;ann;10.5\n2;bob;7.25\n")
    write(tmp_path / "d" / "b.csv", "id,name,amount\n1,ann,10.5\n2,bob,7.25\n")
    with pytest.raises(ValueError):
        src.read_delimited(spark, str(tmp_path / "d"))
    assert src.read_delimited(spark, str(tmp_path / "d"), sep=";", header=True).count() == 4


def test_read_headerless_is_all_text(spark, tmp_path):
    write(tmp_path / "in" / "x.PIP", "1|ann\n2|bob\n")
    write(tmp_path / "in" / "y.PIP", "3|cy\n")
    columns = [{"sequence_number": "2", "source_column_name": "name"}, {"sequence_number": "1", "source_column_name": "id"}]
    df = src.read_any(spark, str(tmp_path / "in" / "*.PIP"), columns)
    assert df.dtypes == [("id", "string"), ("name", "string")]
    assert rows(df) == [("1", "ann"), ("2", "bob"), ("3", "cy")]


def test_xml_tags(spark, tmp_path):
    path = write(tmp_path / "a.xml", "<?xml version='1.0'?><books><book><id>1</id><t>x</t></book><book><id>2</id></book></books>")
    assert src.xml_tags(spark, path) == ("books", "book")
    assert rows(src.read_any(spark, path), "id", "t") == [(1, "x"), (2, None)]
    late = write(tmp_path / "late.xml", "<r>" + "<a><v>1</v></a>" * 9000 + "<b>2</b></r>")
    with pytest.raises(ValueError):
        src.read_xml(spark, late)
    assert src.read_xml(spark, late, row_tag="a").count() == 9000
    two = write(tmp_path / "b.xml", "<r><a>1</a><b>2</b></r>")
    with pytest.raises(ValueError):
        src.xml_tags(spark, two)


def test_json_records_see_late_fields(spark):
    texts = [('{"a": %d}' % i,) for i in range(50)] + [('{"a": 1,\n "late": "x"}',), (None,)]
    df = src.json_records(spark.createDataFrame(texts, "j string"), "j")
    assert sorted(df.columns) == ["a", "late"] and df.filter("late = 'x'").count() == 1 and df.count() == 52


def test_unknown_extension(spark):
    with pytest.raises(ValueError):
        src.read_any(spark, "/x/y.zip")


def test_read_target(spark, tmp_path):
    path = str(tmp_path / "t")
    assert targets.read_target(spark, path) is None
    spark.createDataFrame([(1, "x")], "k int, p string").write.partitionBy("p").parquet(path)
    assert targets.read_target(spark, path, "p").columns == ["k"]


def test_latest_partition_and_dated_files(spark, tmp_path):
    path = str(tmp_path / "t")
    assert targets.read_latest_partition(spark, path, "run_dt") is None
    df = spark.createDataFrame([(1, "2023-12-31"), (2, "2024-01-02"), (3, "2024-01-01")], "k int, run_dt string")
    df.write.partitionBy("run_dt").parquet(path)
    assert rows(targets.read_latest_partition(spark, path, "run_dt"), "k") == [(2,)]
    for name in ("a_20240101.csv", "b_20240201.csv", "c_20240201.csv", "d.csv"):
        write(tmp_path / "files" / name, "x")
    assert [p[-14:] for p in targets.latest_dated_files(spark, str(tmp_path / "files"))] == ["b_20240201.csv", "c_20240201.csv"]


def test_overwrite_can_be_finished_after_a_crash(spark, tmp_path):
    path, temp = str(tmp_path / "final"), str(tmp_path / "tmp")
    spark.range(3).write.parquet(path)
    stored = spark.read.parquet(path)
    assert not sink.finish_overwrite(spark, path, temp)
    sink.overwrite_via_temp(stored.filter("id > 0"), path, temp)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    assert not sink.finish_overwrite(spark, path, temp)
    # stopped between the two steps: the copy is complete, the target is gone
    spark.range(5, 7).write.mode("overwrite").parquet(temp)
    fs.delete(spark, path)
    assert sink.finish_overwrite(spark, path, temp)
    assert rows(spark.read.parquet(path)) == [(5,), (6,)]


def test_landing_files(spark, tmp_path):
    path = str(tmp_path / "l")
    sink.write_landing(spark.range(100).repartition(4), path, files=1)
    assert len([n for n in fs.children(spark, path) if n.startswith("part-")]) == 1


def test_register_and_repair(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "k int, d string")
    df.write.partitionBy("d").parquet(path)
    assert tables.register_table(spark, "default.mr_parts", df, path, "d").count() == 0
    tables.repair_table(spark, "default.mr_parts")
    assert rows(spark.table("default.mr_parts")) == [(1, "2024-01-01"), (2, "2024-01-02")]
    spark.sql("DROP TABLE default.mr_parts")


def test_ddl_types(spark):
    data = [("datetime", "0", None), ("STRING", "20", None), ("string", "0", None), ("decimal", "0", "2"), ("decimal", "12", "2"),
            ("char", "3", None), ("bigint", None, None)]
    df = tables.ddl_types(spark.createDataFrame(data, "target_datatype string, target_length string, target_precision string"))
    assert [r["ddl_type"] for r in df.collect()] == [
        "TIMESTAMP", "VARCHAR(20)", "STRING", "DECIMAL(38,2)", "DECIMAL(12,2)", "CHAR(3)", "BIGINT",
    ]


# ---------------------------------------------------------- JDBC, Kafka options

HOST = {"host": "h", "port": "1", "dbname": "d", "username": "u", "password": "p"}


@pytest.mark.parametrize("dialect,url", [
    ("oracle", "jdbc:oracle:thin:@h:1:d"), ("db2", "jdbc:db2://h:1/d"), ("postgres", "jdbc:postgresql://h:1/d"),
    ("sybase", "jdbc:sybase:Tds:h:1/d?"), ("sqlserver", "jdbc:sqlserver://h:1;databaseName=d"), ("mysql", "jdbc:mysql://h:1/d"),
])
def test_jdbc_urls(dialect, url):
    options = jdbc.read_options(dialect, HOST, table="t")
    assert (options["url"], options["dbtable"], options["fetchsize"]) == (url, "t", "200000") and "ssl" not in options


def test_jdbc_query_form_and_partitions():
    assert jdbc.read_options("postgres", HOST, query="select 1")["query"] == "select 1"
    assert jdbc.read_options("oracle", HOST, query="select 1")["dbtable"] == "(select 1) t"
    split = jdbc.read_options("postgres", HOST, query="q", partition_col="id", lower=1, upper=99)
    assert split["dbtable"] == "(q) t" and split["numPartitions"] == "100" and split["upperBound"] == "99"
    assert jdbc.bounds_query("id", query="q") == "select min(id) as lower_bound, max(id) as upper_bound from (q) t"
    with pytest.raises(ValueError):
        jdbc.read_options("oracle", HOST, query="q", table="t")
    with pytest.raises(ValueError):
        jdbc.read_options("oracle", HOST, query="q", partition_col="id")


def test_lookup_query():
    assert jdbc.lookup_query("s", "dim", ["a", "b"], "sk") == "select a, b, sk from s.dim"


def test_jdbc_ssl_and_truncate():
    assert "sslmode" not in jdbc.connection_options("postgres", {**HOST, "host": "x.rds.example.com"})
    assert jdbc.connection_options("postgres", {**HOST, "ssl": True})["sslmode"] == "verify-full"
    assert jdbc.connection_options("sqlserver", {**HOST, "ssl": True})["trustServerCertificate"] == "false"
    assert jdbc.connection_options("sqlserver", {**HOST, "ssl_unverified": True})["trustServerCertificate"] == "true"
    assert jdbc.write_options("postgres", HOST, "t")["truncate"] == "true"
    assert "truncate" not in jdbc.write_options("oracle", HOST, "t")


def test_kafka_options_and_value(spark):
    options = kafka.read_options("b:9092", "t", starting='{"t":{"0":5}}')
    assert options["endingOffsets"] == "latest" and options["startingOffsets"] == '{"t":{"0":5}}'
    assert kafka.write_options("b", "t")["topic"] == "t"
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert rows(kafka.to_kafka_value(df)) == [("1|x",)]


# ------------------------------------------------------------------- ingestion

COLUMNS = [
    {"sequence_number": "1", "source_column_name": "id", "target_column_name": "id", "target_datatype": "bigint"},
    {"sequence_number": "2", "source_column_name": "v", "target_column_name": "val", "target_datatype": "string"},
]
AT = dt.datetime(2024, 5, 6, 7, 8, 9)


def spec(**extra):
    record = {"pipeline_id": "p1", "target_file_name": "t", "pipeline_columns": COLUMNS, "load_type": "delta", "primary_key_set": "['id']"}
    return Ingestion.from_record({**record, **extra})


def test_records():
    assert as_list("['a', 'b']") == ["a", "b"] and as_list("null") == [] and as_list(None) == [] and as_list('["x"]') == ["x"]
    assert as_list("[{'a': null}]") == [{"a": None}]
    one = spec(log_chng_indicator_key="['op']", target_partition_col="", active="")
    assert one.op_column == "op" and one.partition_col is None and one.active and one.keys == ("id",)
    envs = "[{'environment_name': 'Dev', 'target_bucket_name': 'x', 'n': null}]"
    assert environment_settings(envs, "DEV") == {"environment_name": "Dev", "target_bucket_name": "x", "n": None}


def test_source_query():
    since, until = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    table = spec(source_table_name="s.t")
    assert source_query(table, since, until) == "select id, v from s.t"
    timed = spec(source_table_name="s.t", cdc_timestamp_key="['ts']")
    assert source_query(timed, None, until).endswith("where (ts >= '1900-01-01 00:00:00' AND ts <= '2024-01-02 00:00:00')")
    given = spec(source_query="select * from t where x between '{}' and '{}'", source_table_name="s.t")
    assert source_query(given, since, until) == "select * from t where x between '2024-01-01 00:00:00' and '2024-01-02 00:00:00'"
    assert source_query(given, None, until) == "select id, v from s.t"
    assert source_query(spec(source_query="select 1"), None, until) == "select 1"


def source(spark, data, schema="id string, v string"):
    return spark.createDataFrame(data, schema)


def test_run_delta_upsert_and_log(spark, tmp_path):
    base = str(tmp_path)
    first = run_ingest(spark, spec(), base, AT, source=source(spark, [("1", "a"), ("2", "b")]))
    assert first.written and first.log["landing_count"] == 2 and first.log["final_count"] == 2
    second = run_ingest(spark, spec(), base, AT, source=source(spark, [("2", "B"), ("3", "c"), ("bad", "d")]))
    assert second.log["landing_count"] == 3 and second.log["final_count"] == 4 and second.log["job_status"] == "SUCCESS"
    assert rows(spark.read.parquet(second.final_path)) == [(1, "a"), (2, "B"), (3, "c"), (None, "d")]
    assert log_rows(spark, [first.log, second.log]).count() == 2


def test_log_is_stored_and_gives_the_next_start(spark, tmp_path):
    path = str(tmp_path / "log")
    for minute, data in ((1, [("1", "a")]), (2, [("2", "b")])):
        done = run_ingest(spark, spec(), str(tmp_path), AT.replace(minute=minute), source=source(spark, data))
        runlog.append_log(spark, [done.log], path)
    refused = run_ingest(spark, spec(ola="07:00:00-08:00:00"), str(tmp_path), AT.replace(minute=3), source=source(spark, [("1", "a")]))
    runlog.append_log(spark, [refused.log], path)
    log = runlog.read_log(spark, path)
    assert log.count() == 3
    assert runlog.fetch_from(log, "p1") == AT.replace(minute=2)
    assert runlog.fetch_from(log, "never") == dt.datetime(1900, 1, 1)


def test_run_leaves_its_states_times_and_service_level(spark, tmp_path):
    ticks = iter([0.0, 90.0, 0.0, 10.0])
    path = str(tmp_path / "log")
    late = run_ingest(spark, spec(sla="00:01:00"), str(tmp_path), AT, source=source(spark, [("1", "a")]), log_path=path, clock=lambda: next(ticks))
    assert late.log["sla_met"] == "false" and late.log["execution_end_dttm"] == AT + dt.timedelta(seconds=90)
    broken = source(spark, [("1", "a")]).withColumn("v", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        run_ingest(spark, spec(sla="00:01:00"), str(tmp_path), AT.replace(minute=9), source=broken, log_path=path, clock=lambda: next(ticks))
    log = runlog.read_log(spark, path).orderBy("execution_id", "logged_at").collect()
    assert [r["job_status"] for r in log] == ["STARTED", "SUCCESS", "STARTED", "FAILURE"]
    assert "boom" in log[3]["error_message"] and log[3]["sla_met"] == "true"


def test_repeated_run_replaces_its_partition_only(spark, tmp_path):
    parts = spec(target_partition_col="load_dt", primary_key_set="")
    for day in (0, 1, 1):
        done = run_ingest(spark, parts, str(tmp_path), AT + dt.timedelta(days=day), source=source(spark, [(str(day), "x")]))
    assert rows(spark.read.parquet(done.final_path), "id") == [(0,), (1,)]


def test_run_empty_source_writes_nothing(spark, tmp_path):
    done = run_ingest(spark, spec(), str(tmp_path), AT, source=source(spark, []))
    assert not done.written and done.log["job_status"] == "SUCCESS" and not fs.exists(spark, done.final_path)


def test_run_inside_the_blackout_is_refused(spark, tmp_path):
    done = run_ingest(spark, spec(ola="07:00:00-08:00:00"), str(tmp_path), AT, source=source(spark, [("1", "a")]))
    assert not done.written and done.log["job_status"] == "FAILURE"


def test_run_partition_snapshot(spark, tmp_path):
    parts = spec(target_partition_col="load_dt", primary_key_set="")
    for day in (0, 1):
        done = run_ingest(spark, parts, str(tmp_path), AT + dt.timedelta(days=day), source=source(spark, [(str(day), "x")]), database="default")
    assert targets.partition_values(spark, done.final_path, "load_dt") == ["2024-05-06", "2024-05-07"]
    assert rows(spark.table("default.t")) == [(0, "x", "2024-05-06"), (1, "x", "2024-05-07")]
    spark.sql("DROP TABLE default.t")


def test_run_finishes_an_interrupted_copy(spark, tmp_path):
    base = str(tmp_path)
    run_ingest(spark, spec(), base, AT, source=source(spark, [("1", "a")]))
    done = run_ingest(spark, spec(), base, AT, source=source(spark, [("2", "b")]))
    # the next result was stored, then the copy into place broke off
    spark.createDataFrame([(1, "a"), (2, "B")], "id bigint, val string").write.mode("overwrite").parquet(f"{base}/data/tmp/t")
    fs.delete(spark, done.final_path)
    again = run_ingest(spark, spec(), base, AT, source=source(spark, [("3", "c")]))
    assert rows(spark.read.parquet(again.final_path)) == [(1, "a"), (2, "B"), (3, "c")]


def test_backfill_runs_day_by_day(spark, tmp_path):
    write(tmp_path / "in" / "x.csv", "id,v,ts\n1,a,2024-01-01 09:00:00\n2,b,2024-01-01 12:00:00\n3,c,2024-01-03 01:00:00\n4,d,2024-01-03 12:00:00\n")
    filed = spec(source_type="s3", source_file_path=str(tmp_path / "in"), source_file_name="x.csv", cdc_timestamp_key="['ts']",
                 target_partition_col="load_dt", primary_key_set="")
    done = backfill(spark, filed, str(tmp_path / "base"), dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 3, 5))
    assert [r.written for r in done] == [True, False, True]
    assert targets.partition_values(spark, done[0].final_path, "load_dt") == ["2024-01-01", "2024-01-03"]
    assert rows(spark.read.parquet(done[0].final_path), "id") == [(2,), (3,)]


LATE = [
    ("1", "a", "2024-01-01 23:59:59.999999"), ("2", "b", "2024-01-02 00:00:00"), ("1", "c", "2024-01-02 23:59:59.5"),
    ("3", "d", "2024-01-03 05:00:00"), ("4", "e", "2024-01-03 05:00:00.000001"),
]


def backfilled(spark, tmp_path, **record):
    given = spark.createDataFrame(LATE, "id string, v string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    filed, log = spec(cdc_timestamp_key="['ts']", **record), str(tmp_path / "log")
    done = backfill(spark, filed, str(tmp_path / "base"), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3, 5), source=given, log_path=log)
    return done, spark.read.parquet(done[0].final_path)


def test_backfill_keeps_the_last_second_of_a_day(spark, tmp_path):
    done, stored = backfilled(spark, tmp_path, target_partition_col="load_dt", primary_key_set="")
    assert [(r.log["landing_count"], r.log["final_count"]) for r in done] == [(1, 1), (2, 2), (1, 1)]
    assert rows(stored.selectExpr("id", "cast(load_dt as string)")) == [(1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-02"), (3, "2024-01-03")]


def test_backfill_merges_the_last_row_of_every_key(spark, tmp_path):
    done, stored = backfilled(spark, tmp_path)
    assert rows(stored) == [(1, "c"), (2, "b"), (3, "d")]
    assert [r.log["final_count"] for r in done] == [None, None, 3] and all(r.written for r in done)
    assert spark.read.parquet(str(tmp_path / "log")).where("execution_end_dttm is not null").count() == 3


def test_backfill_of_full_and_appended_tables(spark, tmp_path):
    assert rows(backfilled(spark, tmp_path / "a", load_type="full")[1]) == [(3, "d")]
    assert rows(backfilled(spark, tmp_path / "b", primary_key_set="")[1]) == [(1, "a"), (1, "c"), (2, "b"), (3, "d")]


def test_backfill_reads_the_source_once(spark, tmp_path):
    """Rows pass a counter once, whatever the number of days."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    given = spark.createDataFrame([(str(k), "v", dt.datetime(2024, 1, 1 + k % 9, 12)) for k in range(90)], "id string, v string, ts timestamp_ntz")
    passed = given.mapInArrow(count, given.schema)
    filed = spec(cdc_timestamp_key="['ts']", target_partition_col="load_dt", primary_key_set="")
    done = backfill(spark, filed, str(tmp_path), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 9, 23), source=passed)
    assert len(done) == 9 and seen.value == 90 and spark.read.parquet(done[0].final_path).count() == 90


def test_run_reads_files_with_change_times(spark, tmp_path):
    write(tmp_path / "in" / "x.csv", "id,v,ts\n1,a,2024-01-01 00:00:00\n2,b,2024-02-01 00:00:00\n3,c,2024-03-01 00:00:00\n")
    filed = spec(source_type="s3", source_file_path=str(tmp_path / "in"), source_file_name="x.csv", cdc_timestamp_key="['ts']")
    done = run_ingest(spark, filed, str(tmp_path / "base"), dt.datetime(2024, 2, 15), since=dt.datetime(2024, 1, 15))
    assert rows(spark.read.parquet(done.final_path)) == [(2, "b")]


def test_capture_styles(spark):
    target, typed = source(spark, [("1", "a")]), source(spark, [("1", "b")])
    assert rows(capture(spec(load_type="full"), target, typed)) == [("1", "b")]
    assert rows(capture(spec(primary_key_set=""), target, typed)) == [("1", "a"), ("1", "b")]
    marked = spark.createDataFrame([("1", "b", "DEL"), ("2", "c", "INS")], "id string, v string, op string")
    assert rows(capture(spec(log_chng_indicator_key="['op']"), target, marked)) == [("2", "c")]
    assert rows(capture(spec(log_chng_indicator_key="['op']"), None, marked)) == [("2", "c")]


def test_export_catalog(spark, tmp_path):
    path = str(tmp_path / "in")
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    df.write.parquet(path)
    tables.register_table(spark, "default.mr_export_a", df, path)
    out = targets.export_catalog(spark, "default", str(tmp_path / "out"), {"k": "string"}, prefix="mr_export")
    assert rows(spark.read.parquet(*out)) == [("1", "x")]
    spark.sql("DROP TABLE default.mr_export_a")


# ---------------------------------------------------------------------- stream


def test_batch_merge_is_repeatable_and_empties_buckets(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    target = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "k int, v string")
    stream.write_bucketed(target, path, "k", 4)
    assert rows(stream.read_bucketed(spark, path, target.schema)) == rows(target)
    gone = spark.createDataFrame([(i, None, "DEL") for i in range(20)] + [(99, "n", "INS")], "k int, v string, op string")
    for _ in range(2):  # the same epoch delivered again
        stream.apply_batch(gone, 0, path, staging, "k", target.schema, 4, "op")
    assert rows(stream.read_bucketed(spark, path, target.schema)) == [(99, "n")]
    stream.apply_batch(target.limit(1).withColumn("op", F.lit("INS")), 1, path, staging, "k", target.schema, 4, "op")
    assert fs.children(spark, staging) == ["epoch=1"]


def test_staged_tables_leave_with_their_scope(spark):
    with scratch.staging(spark):
        outer = scratch.stage(spark.range(5), "outer")
        with scratch.staging(spark):
            inner = scratch.stage(outer.withColumn("x", F.lit(1)), "inner")
            kept = inner.collect()
        paths = [f.inputFiles()[0].rsplit("/", 1)[0] for f in (outer, inner)]
        assert fs.exists(spark, paths[0]) and not fs.exists(spark, paths[1])
    assert len(kept) == 5 and not fs.exists(spark, paths[0])
    assert "scope-" not in scratch.work_dir(spark, "later")


def test_batch_without_indicator_keeps_the_latest(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    target = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "k int, n int, v string")
    stream.write_bucketed(target, path, "k", 3)
    batch = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (3, 1, "z")], "k int, n int, v string")
    stream.apply_batch(batch, 0, path, staging, "k", target.schema, 3, order_by="n")
    assert rows(stream.read_bucketed(spark, path, target.schema)) == [(1, 2, "y"), (2, 0, "b"), (3, 1, "z")]


def test_stream_continues_from_its_checkpoint(spark, tmp_path):
    base = str(tmp_path)
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    stream.write_bucketed(target, f"{base}/t", "k", 2)
    for key, text in ((1, "b"), (2, "c")):
        spark.createDataFrame([(key, text, "UPD")], "k int, v string, op string").write.mode("append").parquet(f"{base}/in")
        arriving = spark.readStream.schema("k int, v string, op string").parquet(f"{base}/in")
        stream.apply_changes(arriving, f"{base}/t", f"{base}/cp", "k", target.schema, 2, "op").awaitTermination()
    assert rows(stream.read_bucketed(spark, f"{base}/t", target.schema)) == [(1, "b"), (2, "c")]


