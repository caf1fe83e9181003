"""Source, sink and stream queries: whole tables written and read back.

Folders lie below the shared working folder of the session.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.columns import all_strings
from millrace.queries import fixtures as X
from millrace.queries.registry import Tables, query
from millrace.scratch import work_dir
from millrace.sinks import files as sink
from millrace.sinks import tables
from millrace.sources import files as src
from millrace.sources import jdbc, kafka, targets
from millrace.streaming import changes as stream


@query("SELECT * FROM lineitem")
def src_parquet(t: Tables) -> DataFrame:
    return src.read_any(t.spark, t.path("lineitem"))


_CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query(f"SELECT {_CUSTOMER.replace('c_custkey', 'CAST(c_custkey AS INTEGER) AS c_custkey')} FROM customer")
def src_delimited(t: Tables) -> DataFrame:
    """Separator, header and types are all found in the files."""
    path = work_dir(t.spark, "delimited")
    t.customer.write.option("sep", ";").option("header", True).csv(path)
    return src.read_delimited(t.spark, path)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def src_headerless(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "headerless")
    t.supplier.select("s_suppkey", "s_name", "s_nationkey").write.option("sep", "|").csv(path)
    names = [("2", "name"), ("1", "id"), ("3", "nation")]
    columns = [{"sequence_number": n, "source_column_name": c} for n, c in names]
    return src.read_headerless(t.spark, f"{path}/*.csv", columns)


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer")
def src_xml(t: Tables) -> DataFrame:
    """The row tag is found in the files, the types are inferred."""
    path = work_dir(t.spark, "xml")
    t.customer.drop("c_acctbal").write.format("xml").option("rootTag", "customers").option("rowTag", "customer").save(path)
    return src.read_xml(t.spark, path)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def src_json_records(t: Tables) -> DataFrame:
    return src.json_records(t.events.select("event_id", "props"), "props")


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus FROM orders")
def src_catalog_export(t: Tables) -> DataFrame:
    name = "millrace_export_orders"
    path = work_dir(t.spark, "catalog")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    rows.write.parquet(f"{path}/in")
    tables.register_table(t.spark, f"default.{name}", rows, f"{path}/in")
    written = targets.export_catalog(t.spark, "default", f"{path}/out", {"o_custkey": "string"}, prefix=name)
    return t.spark.read.parquet(*written)


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type <> 'view' THEN event_type END AS event_type,
       CAST(user_id AS VARCHAR) AS user_id FROM events""")
def src_all_string(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "NaN").otherwise(F.col("event_type"))
    return all_strings(t.events.select("event_id", kind.alias("event_type"), "user_id"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src_target_minus_partition(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "target")
    t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    return targets.read_target(t.spark, path, "o_orderstatus")


@query("""
SELECT o_orderkey, o_custkey, date_trunc('year', CAST(o_orderdate AS DATE))::DATE AS run_dt FROM orders
WHERE date_part('year', o_orderdate) = (SELECT MAX(date_part('year', o_orderdate)) FROM orders)""")
def src_latest_partition(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "dated")
    day = F.trunc(F.col("o_orderdate").cast("date"), "year")
    t.orders.select("o_orderkey", "o_custkey", day.alias("run_dt")).write.partitionBy("run_dt").parquet(path)
    return targets.read_latest_partition(t.spark, path, "run_dt")


@query("""
SELECT 'cube' AS partition_column, 17 AS reads, COUNT(*) AS covered, TRUE AS balanced, COUNT(*) FILTER (WHERE l_linenumber = 7) AS null_rows,
       CAST(0 AS BIGINT) AS astray FROM lineitem""")
def src_jdbc_equi_depth(t: Tables) -> DataFrame:
    """Reads of a very uneven column: no range holds over twice the mean, every row is in one."""
    cube = F.when(F.col("l_linenumber") != 7, F.pow("l_extendedprice", F.lit(3)))
    rows = t.lineitem.select(cube.alias("cube"))
    found = jdbc.partition_depths(rows, "cube", jdbc.depth_predicates("cube", jdbc.depth_points(rows, "cube", 16)))
    mean = F.col("covered") / F.col("reads")
    return found.select("partition_column", "reads", "covered", (F.col("largest") <= 2 * mean).alias("balanced"), "null_rows", "astray")


# ----------------------------------------------------------------------- sinks


@query("SELECT * FROM lineitem")
def snk_landing_roundtrip(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "landing")
    sink.write_landing(t.lineitem, path)
    return t.spark.read.schema(t.lineitem.schema).parquet(path)


@query("SELECT o_orderkey, o_custkey + 1 AS o_custkey FROM orders")
def snk_self_overwrite(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "self")
    t.orders.select("o_orderkey", "o_custkey").write.parquet(path)
    stored = t.spark.read.parquet(path)
    sink.overwrite_via_temp(stored.withColumn("o_custkey", F.col("o_custkey") + 1), path)
    return t.spark.read.schema(stored.schema).parquet(path)


@query("""
SELECT o_orderkey, o_orderstatus, '2024-01-01' AS load_dt FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderstatus, '2024-01-02' FROM orders""")
def snk_partition_append(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "append")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    sink.write_partition(rows.filter(F.col("o_orderstatus") == "F"), path, "load_dt", dt.date(2024, 1, 1))
    sink.write_partition(rows, path, "load_dt", dt.date(2024, 1, 2))
    return sink.read_partitioned(t.spark, path, rows, "load_dt")


@query(f"WITH {X.NULLABLE} SELECT concat_ws('|', o_orderkey, priority, custkey, note, o_orderstatus) AS value FROM nullable")
def snk_kafka_value(t: Tables) -> DataFrame:
    return kafka.to_kafka_value(X.nullable_orders(t))


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_type AS kind FROM part")
def src_kafka_value(t: Tables) -> DataFrame:
    messages = kafka.to_kafka_value(t.part.select("p_partkey", "p_name", "p_type"))
    return kafka.from_kafka_value(messages.select(F.col("value").cast("binary").alias("value")), ["id", "name", "kind"])


@query("SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(15,2)) AS price FROM orders")
def snk_register_table(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "registered")
    t.orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price")).write.parquet(path)
    columns = [
        {"sequence_number": 2, "target_column_name": "o_custkey", "target_datatype": "bigint"},
        {"sequence_number": 1, "target_column_name": "o_orderkey", "target_datatype": "bigint"},
        {"sequence_number": 3, "target_column_name": "price", "target_datatype": "decimal", "target_length": "15", "target_precision": "2"},
    ]
    return tables.register_table(t.spark, "default.millrace_orders", columns, path)


@query(f"""WITH {X.COLUMN_RECORDS}
SELECT pipeline_id, sequence_number, column_id, target_datatype, target_length,
       CASE target_datatype WHEN 'decimal' THEN 'DECIMAL(' || target_length || ',2)' WHEN 'string' THEN 'VARCHAR(' || target_length || ')'
            ELSE 'TIMESTAMP' END AS ddl_type FROM column_records""")
def snk_ddl_types(t: Tables) -> DataFrame:
    rows = X.column_records(t)
    return tables.ddl_types(rows).select(
        "pipeline_id", "sequence_number", "column_id", "target_datatype", "target_length", "ddl_type"
    )


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def snk_repair_partitions(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "repair")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    rows.write.partitionBy("o_orderstatus").parquet(path)
    tables.register_table(t.spark, "default.millrace_orders_by_status", rows, path, "o_orderstatus")
    tables.repair_table(t.spark, "default.millrace_orders_by_status")
    return t.spark.table("default.millrace_orders_by_status")


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part")
def snk_csv_roundtrip(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "csv")
    sink.write_csv(t.part.select("p_partkey", "p_name", "p_brand"), path)
    return t.spark.read.option("header", True).csv(path)


# --------------------------------------------------------------------- streams


@query(f"""{X.WITH_CHANGES}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM target
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes WHERE op IS NOT NULL)
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM changes WHERE op IN ('INS', 'UPD')""")
def str_cdc_available_now(t: Tables) -> DataFrame:
    base = work_dir(t.spark, "stream")
    target, rows = X.order_target(t), X.order_changes(t)
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    stream.write_bucketed(target, f"{base}/target", "o_orderkey", buckets)
    rows.write.parquet(f"{base}/in")
    arriving = t.spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    run = stream.apply_changes(arriving, f"{base}/target", f"{base}/checkpoint", "o_orderkey", target.schema, buckets, "op")
    run.awaitTermination()
    return stream.read_bucketed(t.spark, f"{base}/target", target.schema)


@query("SELECT event_id, ts, user_id, event_type FROM events")
def str_dedup(t: Tables) -> DataFrame:
    """Two deliveries of every event; each key comes out once."""
    base = work_dir(t.spark, "dedup")
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    for delivery in ("first", "second"):
        rows.write.parquet(f"{base}/in/{delivery}")
    arriving = t.spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{base}/in")
    once = stream.drop_repeats(arriving, "ts", "event_id", "60 days")
    run = (
        once.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).format("parquet")
        .start(f"{base}/out")
    )
    run.awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(f"{base}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def replay_twice(rows: DataFrame, base: str, time: str, key: str, delay: str, parts: int) -> DataFrame:
    """Every part of ``rows``, in order of time, delivered twice as batches of their own; each key comes out once.

    A part's second delivery finds its last rows in the state and the others
    behind the watermark, so keys older than the delay need not be kept.
    """
    spark = rows.sparkSession
    ends = rows.agg(F.min(time).alias("a"), F.max(time).alias("b")).first()
    step = (ends["b"] - ends["a"]) / parts
    for k in range(parts):
        inside = F.col(time) >= F.lit(ends["a"] + k * step)
        if k < parts - 1:
            inside = inside & (F.col(time) < F.lit(ends["a"] + (k + 1) * step))
        for delivery in ("first", "second"):
            rows.where(inside).coalesce(1).write.parquet(f"{base}/in/part={k}/{delivery}")
    reader = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1)
    once = stream.drop_repeats(reader.parquet(f"{base}/in"), time, key, delay)
    run = (
        once.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).format("parquet")
        .start(f"{base}/out")
    )
    run.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/out")


@query("SELECT event_id, ts, user_id, event_type FROM events")
def str_dedup_expiring(t: Tables) -> DataFrame:
    """Parts of the events delivered twice; state is kept for a day only."""
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    found = replay_twice(rows, work_dir(t.spark, "replay"), "ts", "event_id", "1 day", 3)
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
