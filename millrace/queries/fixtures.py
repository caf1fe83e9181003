"""Operator inputs derived from the whole given tables, in Spark and in SQL.

No input is cut down: every fixture maps all rows of its tables.  Null and
change cases come from attribute values (order priority, market segment, …).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.queries.registry import Tables

# community labels of the domains
LABELS = {"finance": "Money", "ratings": "Grades", "reference": "Lists"}


def cases(column: str, mapping: dict, default=None) -> Column:
    result = None
    for value, label in mapping.items():
        test = F.col(column) == value
        result = F.when(test, F.lit(label)) if result is None else result.when(test, F.lit(label))
    return result.otherwise(F.lit(default)) if default is not None else result


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# ------------------------------------------------------------ orders as target

ORDERS = """orders_typed AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
         CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders)"""

TARGET = ORDERS + """, target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders_typed)"""

CHANGES = """changes AS (
  SELECT CASE WHEN o_orderpriority = '3-MEDIUM' THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey,
         o_custkey, o_orderstatus,
         CAST(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice ELSE o_totalprice + 1 END AS DECIMAL(15,2)) AS o_totalprice,
         o_orderdate,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'UPD' WHEN '5-LOW' THEN 'UPD' WHEN '2-HIGH' THEN 'DEL'
              WHEN '3-MEDIUM' THEN 'INS' END AS op
  FROM orders_typed)"""

WITH_CHANGES = f"WITH {TARGET}, {CHANGES}"


def orders_typed(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority",
    )


def order_target(t: Tables) -> DataFrame:
    return orders_typed(t).drop("o_orderpriority")


def order_changes(t: Tables) -> DataFrame:
    """Every order as an update, deletion, insertion (under a new key) or no change."""
    key, price, priority = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderpriority")
    return orders_typed(t).select(
        F.when(priority == "3-MEDIUM", -key - 1).otherwise(key).alias("o_orderkey"),
        "o_custkey",
        "o_orderstatus",
        F.when(priority == "5-LOW", price).otherwise(price + 1).cast("decimal(15,2)").alias("o_totalprice"),
        "o_orderdate",
        cases("o_orderpriority", {"1-URGENT": "UPD", "5-LOW": "UPD", "2-HIGH": "DEL", "3-MEDIUM": "INS"}).alias("op"),
    )


def order_increment(t: Tables) -> DataFrame:
    """The incoming rows of the change set, without indicator."""
    return order_changes(t).filter(F.col("op").isin("INS", "UPD")).drop("op")


# ---------------------------------------------------- columns that hold nulls

NULLABLE = """nullable AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS priority,
         CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS custkey,
         CAST(NULL AS VARCHAR) AS note,
         o_orderstatus FROM orders)"""


def nullable_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("custkey"),
        F.lit(None).cast("string").alias("note"),
        "o_orderstatus",
    )


# ------------------------------------------------- customers as a dated dimension

DIMENSION = """dimension AS (
  SELECT c_custkey AS entity_id, c_nationkey AS issuer_num, c_mktsegment,
         CAST(DATE '1990-01-01' + c_nationkey * 365 AS TIMESTAMP) AS efft_dtm,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(DATE '1990-01-01' + c_nationkey * 365 + 3650 AS TIMESTAMP) END AS term_dtm,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN TIMESTAMP '2001-01-01 00:00:00'
              ELSE TIMESTAMP '9999-12-31 00:00:00' END AS end_dtm
  FROM customer)"""


def dated_customers(t: Tables) -> DataFrame:
    start = F.date_add(F.lit("1990-01-01").cast("date"), F.col("c_nationkey") * 365)
    return t.customer.select(
        F.col("c_custkey").alias("entity_id"),
        F.col("c_nationkey").alias("issuer_num"),
        "c_mktsegment",
        start.cast("timestamp_ntz").alias("efft_dtm"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.date_add(start, 3650).cast("timestamp_ntz")).alias("term_dtm"),
        F.when(F.col("c_mktsegment") == "MACHINERY", ntz("2001-01-01 00:00:00"))
        .otherwise(ntz("9999-12-31 00:00:00"))
        .alias("end_dtm"),
    )


# ------------------------------------------------ customer snapshots for type 2

SNAPSHOTS = """day1 AS (
  SELECT c_name, c_custkey, c_nationkey, CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal, c_mktsegment FROM customer),
numbered AS (SELECT *, CAST(DENSE_RANK() OVER (ORDER BY c_name) AS BIGINT) AS customer_sk FROM day1),
fresh AS (
  SELECT c_name || '-N' AS c_name, c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM day1 WHERE c_mktsegment = 'HOUSEHOLD'),
fresh_numbered AS (
  SELECT *, CAST((SELECT MAX(customer_sk) FROM numbered) + DENSE_RANK() OVER (ORDER BY c_name) AS BIGINT) AS customer_sk FROM fresh)"""


def customer_snapshot(t: Tables, bump: int = 0, complete: bool = True) -> DataFrame:
    """``bump`` raises the balance of one segment; an incomplete snapshot misses
    one segment and brings copies of another under new names."""
    base = t.customer.select(
        "c_name", "c_custkey", "c_nationkey", F.col("c_acctbal").cast("decimal(15,2)").alias("c_acctbal"), "c_mktsegment"
    )
    if complete:
        return base
    raised = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + bump).otherwise(F.col("c_acctbal"))
    kept = base.filter(F.col("c_mktsegment") != "MACHINERY").withColumn("c_acctbal", raised.cast("decimal(15,2)"))
    copies = base.filter(F.col("c_mktsegment") == "HOUSEHOLD").withColumn("c_name", F.concat("c_name", F.lit("-N")))
    return kept.unionByName(copies)


# ------------------------------------------------------ line items as metadata

COLUMN_RECORDS = """column_records AS (
  SELECT l_partkey AS column_id, CAST(l_orderkey AS VARCHAR) AS pipeline_id, '1' AS version_number,
         l_linenumber AS sequence_number,
         'src_' || l_linenumber AS source_column_name, 'col_' || l_linenumber AS target_column_name,
         CASE l_linestatus WHEN 'O' THEN 'varchar2' ELSE 'int' END AS source_datatype,
         CASE l_returnflag WHEN 'R' THEN 'decimal' WHEN 'A' THEN 'string' ELSE 'datetime' END AS target_datatype,
         CASE WHEN l_returnflag <> 'N' THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS target_length,
         CASE WHEN l_returnflag = 'R' THEN '2' END AS target_precision,
         CASE WHEN l_returnflag = 'N' THEN 'yyyy-MM-dd' END AS target_datetime_format
  FROM lineitem)"""


def column_records(t: Tables) -> DataFrame:
    """Every line item as a column record of the pipeline that is its order."""
    flag = F.col("l_returnflag")
    return t.lineitem.select(
        F.col("l_partkey").alias("column_id"),
        F.col("l_orderkey").cast("string").alias("pipeline_id"),
        F.lit("1").alias("version_number"),
        F.col("l_linenumber").alias("sequence_number"),
        F.concat(F.lit("src_"), "l_linenumber").alias("source_column_name"),
        F.concat(F.lit("col_"), "l_linenumber").alias("target_column_name"),
        F.when(F.col("l_linestatus") == "O", "varchar2").otherwise("int").alias("source_datatype"),
        cases("l_returnflag", {"R": "decimal", "A": "string"}, "datetime").alias("target_datatype"),
        F.when(flag != "N", F.col("l_quantity").cast("int").cast("string")).alias("target_length"),
        F.when(flag == "R", "2").alias("target_precision"),
        F.when(flag == "N", "yyyy-MM-dd").alias("target_datetime_format"),
    )


INVENTORY = """inventory AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS pipeline_id, '1' AS version_number, 'app_' || o_orderstatus AS app_name,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'finance' WHEN '2-HIGH' THEN 'ratings' WHEN '3-MEDIUM' THEN 'esg'
              WHEN '5-LOW' THEN 'reference' ELSE 'other' END AS domain_name,
         'loads ' || o_orderpriority AS pipeline_desc,
         CASE WHEN o_orderstatus = 'F' THEN 'false' ELSE 'true' END AS active,
         CASE WHEN o_totalprice >= 100000 THEN 'published' ELSE 'draft' END AS status,
         'ord_' || o_orderkey AS target_file_name, CAST(NULL AS VARCHAR) AS target_table_name,
         '[{"environment_name":"DEV","target_bucket_name":"dev-' || o_orderstatus
           || '"},{"environment_name":"prod","target_bucket_name":"prd-' || o_orderstatus || '"}]' AS target_environments
  FROM orders)"""


def inventory(t: Tables) -> DataFrame:
    """Every order as an inventory record."""
    domains = {"1-URGENT": "finance", "2-HIGH": "ratings", "3-MEDIUM": "esg", "5-LOW": "reference"}
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("pipeline_id"),
        F.lit("1").alias("version_number"),
        F.concat(F.lit("app_"), "o_orderstatus").alias("app_name"),
        cases("o_orderpriority", domains, "other").alias("domain_name"),
        F.concat(F.lit("loads "), "o_orderpriority").alias("pipeline_desc"),
        F.when(F.col("o_orderstatus") == "F", "false").otherwise("true").alias("active"),
        F.when(F.col("o_totalprice") >= 100000, "published").otherwise("draft").alias("status"),
        F.concat(F.lit("ord_"), "o_orderkey").alias("target_file_name"),
        F.lit(None).cast("string").alias("target_table_name"),
        F.concat(
            F.lit('[{"environment_name":"DEV","target_bucket_name":"dev-'), "o_orderstatus",
            F.lit('"},{"environment_name":"prod","target_bucket_name":"prd-'), "o_orderstatus", F.lit('"}]'),
        ).alias("target_environments"),
    )


# --------------------------------------------------------- events as a run log

RUNS = """runs AS (
  SELECT CAST(user_id AS VARCHAR) AS pipeline_id, event_id AS execution_id, ts AS execution_start_dttm,
         ts + to_microseconds(CAST(ROUND(value * 1000000) AS BIGINT)) AS execution_end_dttm,
         CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'signup' THEN 'SUCCESS' WHEN 'error' THEN 'FAILURE'
              WHEN 'view' THEN 'IN_PROGRESS' ELSE 'STARTED' END AS job_status,
         CASE event_type WHEN 'purchase' THEN '00:01:00' WHEN 'signup' THEN '' WHEN 'error' THEN NULL
              WHEN 'view' THEN '00:00:30' ELSE '01:00:00' END AS sla,
         CASE event_type WHEN 'purchase' THEN '01:00:00-03:00:00' WHEN 'view' THEN '12:30:00-18:00:00'
              WHEN 'error' THEN NULL ELSE '' END AS ola
  FROM events)"""


def runs(t: Tables) -> DataFrame:
    """Every event as a run of the pipeline that is its user."""
    states = {"purchase": "SUCCESS", "signup": "SUCCESS", "error": "FAILURE", "view": "IN_PROGRESS"}
    kind = F.col("event_type")
    took = F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
    return t.events.select(
        F.col("user_id").cast("string").alias("pipeline_id"),
        F.col("event_id").alias("execution_id"),
        F.col("ts").alias("execution_start_dttm"),
        (F.col("ts") + took).alias("execution_end_dttm"),
        cases("event_type", states, "STARTED").alias("job_status"),
        F.when(kind == "purchase", "00:01:00").when(kind == "signup", "").when(kind == "error", F.lit(None))
        .when(kind == "view", "00:00:30").otherwise("01:00:00").alias("sla"),
        F.when(kind == "purchase", "01:00:00-03:00:00").when(kind == "view", "12:30:00-18:00:00")
        .when(kind == "error", F.lit(None)).otherwise("").alias("ola"),
    )
