"""Change-capture queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.plans.chains import Level, scd2_chain
from millrace.queries import fixtures as X
from millrace.queries.registry import Tables, query
from millrace.scratch import stage, work_dir
from millrace.sinks import versions

COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"


@query(f"""{X.WITH_CHANGES}
SELECT {COLUMNS} FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes WHERE op IS NOT NULL)
UNION ALL SELECT {COLUMNS} FROM changes WHERE op IN ('INS', 'UPD')""")
def cdc_indicator_merge(t: Tables) -> DataFrame:
    return cdc.merge_by_indicator(X.order_target(t), X.order_changes(t), "o_orderkey", "op")


@query(f"""{X.WITH_CHANGES}, incoming AS (SELECT {COLUMNS} FROM changes WHERE op IN ('INS', 'UPD'))
SELECT {COLUMNS} FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming) UNION ALL SELECT * FROM incoming""")
def cdc_upsert_replace(t: Tables) -> DataFrame:
    return cdc.upsert(X.order_target(t), X.order_increment(t), "o_orderkey")


@query(f"""{X.WITH_CHANGES}, incoming AS (SELECT {COLUMNS} FROM changes WHERE op IN ('INS', 'UPD')),
matched AS (SELECT * FROM incoming WHERE o_orderkey IN (SELECT o_orderkey FROM target))
(SELECT {COLUMNS} FROM target EXCEPT SELECT * FROM matched) UNION ALL SELECT * FROM incoming""")
def cdc_upsert_keep_versions(t: Tables) -> DataFrame:
    return cdc.upsert(X.order_target(t), X.order_increment(t), "o_orderkey", mode="keep_versions")


@query(f"""{X.WITH_CHANGES}
SELECT {COLUMNS} FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes WHERE op IS NOT NULL)
UNION ALL SELECT {COLUMNS} FROM changes WHERE op IN ('INS', 'UPD')""")
def cdc_versioned_merge(t: Tables) -> DataFrame:
    """Indicator merge into a stored table; only files with a changed key are written anew."""
    path = work_dir(t.spark, "versions")
    versions.write_version(X.order_target(t), path, "o_orderkey")
    versions.merge_version(t.spark, path, X.order_changes(t), "op")
    return versions.read_version(t.spark, path)


@query(f"""{X.WITH_CHANGES}, incoming AS (SELECT {COLUMNS} FROM changes WHERE op IN ('INS', 'UPD'))
SELECT {COLUMNS} FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming) UNION ALL SELECT * FROM incoming""")
def cdc_versioned_upsert(t: Tables) -> DataFrame:
    """Keyed upsert into a stored table, twice: the repeated one changes nothing."""
    path = work_dir(t.spark, "versions")
    versions.write_version(X.order_target(t), path, "o_orderkey")
    for _ in range(2):
        versions.upsert_version(t.spark, path, X.order_increment(t))
    return versions.read_version(t.spark, path)


@query(f"""{X.WITH_CHANGES}
SELECT {COLUMNS} FROM changes WHERE op IN ('INS', 'UPD') UNION ALL SELECT {COLUMNS} FROM target""")
def cdc_append(t: Tables) -> DataFrame:
    return cdc.append(X.order_target(t), X.order_increment(t))


@query(f"{X.WITH_CHANGES} SELECT {COLUMNS} FROM changes WHERE op IN ('INS', 'UPD')")
def cdc_partition_snapshot(t: Tables) -> DataFrame:
    return cdc.partition_snapshot(X.order_target(t), X.order_increment(t))


@query(f"WITH {X.TARGET} SELECT {COLUMNS} FROM target")
def cdc_first_load(t: Tables) -> DataFrame:
    return cdc.first_load(X.order_target(t))


@query(f"""{X.WITH_CHANGES}, incoming AS (SELECT {COLUMNS} FROM changes WHERE op IN ('INS', 'UPD'))
SELECT *, TIMESTAMP '2024-03-01 04:05:06' AS etl_insert_ts FROM (
  SELECT {COLUMNS} FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming) UNION ALL SELECT * FROM incoming)""")
def cdc_replace_stamped(t: Tables) -> DataFrame:
    return cdc.replace_stamped(X.order_target(t), X.order_increment(t), "o_orderkey", dt.datetime(2024, 3, 1, 4, 5, 6))


@query(f"""WITH {X.SNAPSHOTS}
SELECT *, DATE '2024-01-01' AS start_dt, DATE '2999-12-31' AS end_dt FROM numbered""")
def cdc_scd2_initial(t: Tables) -> DataFrame:
    return cdc.scd2_initial(X.customer_snapshot(t), "c_name", "customer_sk", dt.date(2024, 1, 1))


_BALANCE = "CAST(c_acctbal + {0} AS DECIMAL(15,2))"


def _versions(missing: str) -> str:
    """All versions after loads on 1 January, 1 February and 1 March: one
    segment changes twice, one leaves, copies of one arrive."""
    row = "SELECT c_name, c_custkey, c_nationkey, {b} AS c_acctbal, c_mktsegment, customer_sk, DATE '{s}' AS start_dt, DATE '{e}' AS end_dt FROM {t}"

    def rows(table, where, start, end="2999-12-31", bump=0):
        return row.format(b=_BALANCE.format(bump), s=start, e=end, t=table) + (f" WHERE {where}" if where else "")

    building = "c_mktsegment = 'BUILDING'"
    parts = [
        rows("numbered", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')", "2024-01-01"),
        rows("numbered", building, "2024-01-01", "2024-01-31"),
        rows("numbered", building, "2024-02-01", "2024-02-29", 1),
        rows("numbered", building, "2024-03-01", bump=2),
        rows("fresh_numbered", "", "2024-02-01"),
    ]
    if missing == "close":
        parts.append(rows("numbered", "c_mktsegment = 'MACHINERY'", "2024-01-01", "2024-01-31"))
    return f"WITH {X.SNAPSHOTS} " + " UNION ALL ".join(parts)


def _three_loads(t: Tables, on_missing: str) -> DataFrame:
    stored = stage(cdc.scd2_initial(X.customer_snapshot(t), "c_name", "customer_sk", dt.date(2024, 1, 1)), "scd2")
    for bump, day in ((1, dt.date(2024, 2, 1)), (2, dt.date(2024, 3, 1))):
        source = X.customer_snapshot(t, bump, complete=False)
        # the target is read twice by a merge, so each load is stored first
        stored = stage(cdc.scd2_merge(stored, source, "c_name", "customer_sk", day, on_missing=on_missing), "scd2")
    return stored


@query(_versions("drop"))
def cdc_scd2_merge(t: Tables) -> DataFrame:
    return _three_loads(t, "drop")


@query(_versions("close"))
def cdc_scd2_on_missing_close(t: Tables) -> DataFrame:
    return _three_loads(t, "close")


# ------------------------------------------------------- customer -> order chain

CHAIN = (
    Level("customer", "c_name", "customer_sk"),
    Level("orders", "order_no", "order_sk", on=[("o_custkey", "c_custkey")]),
    Level(
        "lineitem", "line_no", "line_sk", on=[("l_orderkey", "o_orderkey")], on_duplicate="latest",
        order_by=["l_shipdate", "l_partkey", "l_suppkey"],
    ),
)


def chain_sources(t: Tables, later: bool, new_lines: bool = False) -> dict[str, DataFrame]:
    """Day one: the tables as they are.  Later: one segment of the customers and
    one priority of the orders changed, orders of another priority came twice;
    with ``new_lines`` every line came again under the copied order's key."""
    raised = F.when(F.col("c_mktsegment") == "BUILDING", "CHANGED").otherwise(F.col("c_mktsegment"))
    customers = t.customer.select("c_name", "c_custkey", (raised if later else F.col("c_mktsegment")).alias("c_mktsegment"))
    orders = t.orders.select(
        F.concat(F.lit("O"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("order_no"), "o_orderkey", "o_custkey",
        "o_orderstatus", "o_orderpriority",
    )
    if later:
        status = F.when(F.col("o_orderpriority") == "1-URGENT", "X").otherwise(F.col("o_orderstatus"))
        copies = orders.filter(F.col("o_orderpriority") == "2-HIGH").withColumn("order_no", F.concat("order_no", F.lit("-N")))
        copies = copies.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
        orders = orders.withColumn("o_orderstatus", status).unionByName(copies)
    number = F.lpad(F.col("l_orderkey").cast("string"), 12, "0")
    lines = t.lineitem.select(
        F.concat(number, F.lit("-"), "l_linenumber").alias("line_no"), "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"
    )
    if new_lines:
        again = lines.withColumns({"line_no": F.concat("line_no", F.lit("-N")), "l_orderkey": -F.col("l_orderkey") - 1})
        lines = lines.unionByName(again)
    return {"customer": customers, "orders": orders, "lineitem": lines}


_CHAIN_SQL = """
WITH cust AS (SELECT c_name, c_custkey, c_mktsegment, DENSE_RANK() OVER (ORDER BY c_name) AS customer_sk FROM customer),
ord AS (
  SELECT 'O' || LPAD(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_no, o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders),
ord_numbered AS (SELECT *, DENSE_RANK() OVER (ORDER BY order_no) AS order_sk FROM ord),
ord_copies AS (
  SELECT order_no || '-N' AS order_no, -o_orderkey - 1 AS o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM ord WHERE o_orderpriority = '2-HIGH'),
copies_numbered AS (
  SELECT *, (SELECT MAX(order_sk) FROM ord_numbered) + DENSE_RANK() OVER (ORDER BY order_no) AS order_sk FROM ord_copies),
ord_rows AS (
  SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN DATE '2024-01-31' ELSE DATE '2999-12-31' END AS end_dt, DATE '2024-01-01' AS start_dt FROM ord_numbered
  UNION ALL SELECT * REPLACE ('X' AS o_orderstatus), DATE '2999-12-31', DATE '2024-02-01' FROM ord_numbered WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT *, DATE '2999-12-31', DATE '2024-02-01' FROM copies_numbered),
line AS (
  SELECT LPAD(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber AS line_no, l_orderkey, l_partkey, l_suppkey, l_shipdate FROM lineitem),
one_line AS (
  SELECT * EXCLUDE (n) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY line_no ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS n FROM line) WHERE n = 1),
line_numbered AS (SELECT *, DENSE_RANK() OVER (ORDER BY line_no) AS line_sk FROM one_line)
"""


@query(_CHAIN_SQL + """
SELECT order_no, o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(order_sk AS BIGINT) AS order_sk,
       CAST(customer_sk AS BIGINT) AS customer_sk, start_dt, end_dt
FROM ord_rows JOIN cust ON c_custkey = o_custkey""")
def cdc_scd2_chain(t: Tables) -> DataFrame:
    first = scd2_chain(CHAIN[:2], chain_sources(t, False), dt.date(2024, 1, 1))
    second = scd2_chain(CHAIN[:2], chain_sources(t, True), dt.date(2024, 2, 1), targets=first)
    return second["orders"]


# ------------------------------------------------------------------ satellites


def fee_rows(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("line_id"), F.col("l_returnflag").alias("name"), F.col("l_linestatus").alias("program")
    )


_SATELLITE = """
WITH rows AS (
  SELECT l_partkey AS line_id, l_returnflag AS name, l_linestatus AS program, l_shipdate FROM lineitem),
hashed AS (SELECT line_id, name, program, md5('1:' || name || ',1:' || program) AS diff_hash, '2024-01-01' AS load_dtm
           FROM rows WHERE l_shipdate < TIMESTAMP '1997-01-01 00:00:00'
           UNION ALL SELECT line_id, name, program, md5('1:' || name || ',1:' || program), '2024-02-01' FROM rows)
SELECT line_id, name, program, diff_hash, MIN(load_dtm) AS load_dtm FROM hashed GROUP BY 1, 2, 3, 4"""


@query(_SATELLITE)
def cdc_satellite(t: Tables) -> DataFrame:
    """First load with the early lines, second load with all of them."""
    keyed = lambda df: df.withColumn("diff_hash", cdc.row_hash(["name", "program"]))
    early = t.lineitem.filter(F.col("l_shipdate") < X.ntz("1997-01-01 00:00:00"))
    old = keyed(
        early.select(F.col("l_partkey").alias("line_id"), F.col("l_returnflag").alias("name"), F.col("l_linestatus").alias("program"))
    ).withColumn("load_dtm", F.lit("2024-01-01"))
    stored = cdc.satellite_append(None, old, "line_id", ["name", "program"])
    new = keyed(fee_rows(t)).withColumn("load_dtm", F.lit("2024-02-01"))
    return cdc.satellite_append(stored, new, "line_id", ["name", "program"])


@query("""
SELECT p_partkey, p_brand, p_type, md5(CAST(p_partkey AS VARCHAR)) AS fee_hub_hash,
       md5(concat_ws(',', LENGTH(p_brand) || ':' || p_brand, LENGTH(p_type) || ':' || p_type)) AS diff_hash FROM part""")
def cdc_hash_keys(t: Tables) -> DataFrame:
    return cdc.with_hash_keys(t.part.select("p_partkey", "p_brand", "p_type"), "p_partkey", ["p_type", "p_brand"])


@query("""
WITH span AS (SELECT user_id, MIN(ts) AS since, MAX(ts) AS until FROM events GROUP BY user_id),
days AS (SELECT *, CAST(UNNEST(generate_series(CAST(since AS DATE), CAST(until AS DATE), INTERVAL 1 DAY)) AS DATE) AS window_day FROM span)
SELECT user_id, window_day,
       CASE WHEN window_day = CAST(since AS DATE) THEN since ELSE CAST(window_day AS TIMESTAMP) END AS window_from,
       CASE WHEN window_day = CAST(until AS DATE) THEN until ELSE CAST(window_day AS TIMESTAMP) + INTERVAL 1 DAY END AS window_till,
       window_day = CAST(until AS DATE) AS till_included
FROM days""")
def cdc_daily_windows(t: Tables) -> DataFrame:
    span = t.events.groupBy("user_id").agg(F.min("ts").alias("since"), F.max("ts").alias("until"))
    return cdc.daily_windows(span, "since", "until", keep=["user_id"])
