"""Aggregate and pivot queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators.cdc import classify_changes, scd2_initial
from millrace.queries import fixtures as X
from millrace.queries.registry import Tables, query
from millrace.sources.jdbc import partition_bounds



EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# values of a piece: small, so that cells of the test tables have several
CELL_VALUES, LINE_ROWS = 10, 100


def part_sql(keys: str, order: str, rows: int) -> str:
    """Piece of a sorted group by position."""
    return f"CAST((ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) - 1) // {rows} AS BIGINT)"


@query(f"""
WITH parsed AS (SELECT user_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
paged AS (SELECT *, {part_sql('user_id, event_type', 'k NULLS LAST', CELL_VALUES)} AS part FROM parsed)
SELECT user_id, part,
       {', '.join(f"COALESCE(string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FILTER (WHERE event_type = '{e}'), '') AS {e}" for e in EVENT_TYPES)}
FROM paged GROUP BY user_id, part""")
def agg_pivot_concat(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", F.from_json("props", "k int")["k"].alias("k"))
    return A.pivot_concat(rows, "user_id", "event_type", "k", EVENT_TYPES, page_rows=CELL_VALUES)


@query("""
SELECT user_id, """ + ", ".join(
    f"CAST(SUM(CASE WHEN event_type = '{e}' THEN CAST(value AS DECIMAL(12,2)) END) AS DECIMAL(22,2)) AS {e}" for e in EVENT_TYPES
) + " FROM events GROUP BY user_id")
def agg_pivot_table(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value"))
    return A.pivot_table(rows, "user_id", "event_type", "value", "sum", EVENT_TYPES)


@query(f"""
WITH paged AS (SELECT *, {part_sql('l_suppkey', 'l_orderkey, l_linenumber, l_partkey, l_returnflag', LINE_ROWS)} AS part FROM lineitem)
SELECT CAST(l_suppkey AS BIGINT) AS l_suppkey, part,
       '[' || string_agg('{{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey
         || ',"l_returnflag":"' || l_returnflag || '"}}', ',' ORDER BY l_orderkey, l_linenumber, l_partkey, l_returnflag) || ']' AS lines
FROM paged GROUP BY l_suppkey, part""")
def agg_pack_json(t: Tables) -> DataFrame:
    fields = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"]
    return A.pack_json(t.lineitem, "l_suppkey", fields, "lines", page_rows=LINE_ROWS)


@query("SELECT MAX(o_orderkey) AS max_o_orderkey FROM orders")
def agg_max_key(t: Tables) -> DataFrame:
    return A.max_key(t.orders, "o_orderkey")


@query("SELECT CAST(MIN(TRUNC(o_totalprice)) AS BIGINT) AS lower_bound, CAST(MAX(TRUNC(o_totalprice)) AS BIGINT) AS upper_bound FROM orders")
def agg_bounds(t: Tables) -> DataFrame:
    return A.bounds(t.orders, "o_totalprice")


@query("""
SELECT 'l_extendedprice' AS partition_column, CAST(TRUNC(MIN(l_extendedprice)) AS BIGINT) AS lower_bound,
       CAST(TRUNC(MAX(l_extendedprice)) AS BIGINT) AS upper_bound, 100 AS num_partitions FROM lineitem""")
def src_jdbc_partition_bounds(t: Tables) -> DataFrame:
    return partition_bounds(t.lineitem, "l_extendedprice")


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def agg_distinct(t: Tables) -> DataFrame:
    return A.remove_duplicates(t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS n FROM lineitem)
WHERE n = 1""")
def agg_drop_duplicates(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return A.drop_duplicates(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query("SELECT o_orderstatus, o_orderpriority FROM orders GROUP BY 1, 2")
def agg_group_distinct(t: Tables) -> DataFrame:
    return A.group_distinct(t.orders, "o_orderstatus", "o_orderpriority")


@query(f"""WITH {X.SNAPSHOTS}, c AS (
  SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'update' WHEN 'MACHINERY' THEN 'missing' ELSE 'unchanged' END AS change FROM day1
  UNION ALL SELECT 'insert' FROM fresh)
SELECT change, CAST(COUNT(*) AS BIGINT) AS rows FROM c GROUP BY change""")
def agg_change_counts(t: Tables) -> DataFrame:
    stored = scd2_initial(X.customer_snapshot(t), "c_name", "customer_sk", dt.date(2024, 1, 1))
    changes = classify_changes(stored, X.customer_snapshot(t, 1, complete=False), "c_name", skip=["customer_sk"])
    return A.phase_counts(changes, "change", "change")
