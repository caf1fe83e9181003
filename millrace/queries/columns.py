"""Projection, filter and function queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import row_hash
from millrace.operators import columns as C
from millrace.operators import filters
from millrace.queries import fixtures as X
from millrace.queries.registry import Tables, query


@query("""
WITH l AS (SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS p FROM orders),
     r AS (SELECT c_name, ROW_NUMBER() OVER (ORDER BY c_name) AS p FROM customer)
SELECT o_orderkey, o_custkey, c_name FROM l JOIN r USING (p)""")
def prj_add_column(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey")
    return C.add_column(rows, "c_name", t.customer.select("c_name"), "string", "o_orderkey", "c_name")


@query("SELECT c_custkey, c_name, 'web' AS channel FROM customer")
def prj_add_field(t: Tables) -> DataFrame:
    return C.add_field(t.customer.select("c_custkey", "c_name"), "channel", "web")


@query("SELECT c_custkey, 'web' AS channel, 7 AS batch, TRUE AS active FROM customer")
def prj_add_fields(t: Tables) -> DataFrame:
    return C.add_fields(t.customer.select("c_custkey"), [["channel", "web"], ["batch", 7], ["active", True]])


@query("SELECT o_orderkey, o_orderstatus, o_orderstatus || '/' || o_orderpriority AS label FROM orders")
def prj_computed_field(t: Tables) -> DataFrame:
    label = F.concat("o_orderstatus", F.lit("/"), "o_orderpriority")
    return C.add_computed(t.orders, "label", label).select("o_orderkey", "o_orderstatus", "label")


@query("SELECT o_orderdate, o_orderkey, o_custkey FROM orders")
def prj_get_columns(t: Tables) -> DataFrame:
    return C.get_columns(t.orders, "o_orderdate", "o_orderkey", "o_custkey")


@query("SELECT o_custkey, o_orderkey FROM orders")
def prj_reorder_to_target(t: Tables) -> DataFrame:
    target = t.orders.select("o_custkey", "o_orderkey")
    return C.reorder_like(t.orders.select("o_orderkey", "o_custkey"), target)


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment FROM customer")
def prj_rename(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return C.rename(rows, {"c_custkey": "id", "c_name": "name", "not_there": "x"})


@query(f"WITH {X.NULLABLE} SELECT o_orderkey, o_orderstatus FROM nullable")
def prj_drop_na_columns_any(t: Tables) -> DataFrame:
    return C.drop_null_columns(X.nullable_orders(t), "any")


@query(f"WITH {X.NULLABLE} SELECT o_orderkey, priority, custkey, o_orderstatus FROM nullable")
def prj_drop_na_columns_all(t: Tables) -> DataFrame:
    return C.drop_null_columns(X.nullable_orders(t), "all")


@query("SELECT p_partkey, p_name, p_size FROM part")
def prj_cut_out(t: Tables) -> DataFrame:
    return C.cut_out(t.part, ["p_brand", "p_type", "p_retailprice"])


@query("SELECT p_partkey, LOWER(p_brand) AS p_brand, LOWER(p_type) AS p_type FROM part")
def prj_conversion(t: Tables) -> DataFrame:
    return C.convert(t.part.select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"], F.lower, "string")


@query(f"""WITH {X.NULLABLE}
SELECT o_orderkey, CASE WHEN custkey > 100 THEN LOWER(priority) ELSE priority END AS priority, custkey FROM nullable""")
def prj_conditional_conversion(t: Tables) -> DataFrame:
    rows = X.nullable_orders(t).select("o_orderkey", "priority", "custkey")
    return C.convert_when(rows, "priority", F.lower, "custkey > 100")


@query("SELECT p_partkey, TRY_CAST(CASE WHEN p_type = 'PROMO' THEN p_name ELSE CAST(p_size AS VARCHAR) || '.25' END AS FLOAT) AS v FROM part")
def prj_to_float(t: Tables) -> DataFrame:
    text = F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(F.concat(F.col("p_size"), F.lit(".25")))
    return C.to_float(t.part.select("p_partkey", text.alias("v")), "v")


@query("SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE SUBSTR(o_orderpriority, 1, 1) END AS INTEGER) AS v FROM orders")
def prj_to_int(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(F.substring("o_orderpriority", 1, 1))
    return C.to_int(t.orders.select("o_orderkey", text.alias("v")), "v")


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def prj_to_string(t: Tables) -> DataFrame:
    return C.to_string(t.orders.select("o_orderkey", "o_custkey"), "o_custkey")


@query("""
WITH r AS (
  SELECT event_id,
         CASE event_type WHEN 'click' THEN 'NR' WHEN 'view' THEN 'WD' WHEN 'error' THEN NULL ELSE event_type END AS a,
         CASE event_type WHEN 'click' THEN '' WHEN 'view' THEN 'N/A' ELSE 'b' END AS b,
         CASE WHEN event_type <> 'view' THEN 'c' END AS c FROM events),
s AS (SELECT *, ['NR','WR','WD','PIF','nan','NaN','None','','N/A'] AS none FROM r)
SELECT event_id, COALESCE(CASE WHEN NOT list_contains(none, a) THEN a END, CASE WHEN NOT list_contains(none, b) THEN b END,
  CASE WHEN NOT list_contains(none, c) THEN c END) AS rating FROM s""")
def prj_first_non_null(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    rows = t.events.select(
        "event_id",
        F.when(kind == "click", "NR").when(kind == "view", "WD").when(kind == "error", F.lit(None)).otherwise(kind).alias("a"),
        F.when(kind == "click", "").when(kind == "view", "N/A").otherwise("b").alias("b"),
        F.when(kind != "view", "c").alias("c"),
    )
    return C.first_value(rows, "rating", "a", "b", "c").select("event_id", "rating")


ORDER_COLUMNS = [
    {"sequence_number": "2", "source_column_name": "o_custkey", "target_column_name": "customer_id", "target_datatype": "STRING", "target_length": "9"},
    {"sequence_number": "1", "source_column_name": "o_orderkey", "target_column_name": "order_id", "target_datatype": "bigint"},
    {"sequence_number": "3", "source_column_name": "o_totalprice", "target_column_name": "price", "target_datatype": "decimal", "target_length": "15", "target_precision": "2"},
    {"sequence_number": "4", "source_column_name": "o_orderdate", "target_column_name": "order_day", "target_datatype": "string", "target_datetime_format": "yyyy/MM/dd"},
    {"sequence_number": "5", "source_column_name": "o_orderpriority", "target_column_name": "priority_no", "target_datatype": "int"},
    {"sequence_number": "6", "source_column_name": "o_orderdate", "target_column_name": "ordered_at", "target_datatype": "date"},
]


@query("""
SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_totalprice AS DECIMAL(15,2)) AS price,
       strftime(o_orderdate, '%Y/%m/%d') AS order_day, TRY_CAST(o_orderpriority AS INTEGER) AS priority_no,
       CAST(o_orderdate AS DATE) AS ordered_at, o_orderstatus FROM orders""")
def prj_typed_select(t: Tables) -> DataFrame:
    return C.typed_select(t.orders, ORDER_COLUMNS, keep=["o_orderstatus"])


@query("SELECT r_regionkey, r_name, n_nationkey, n_name FROM region JOIN nation ON n_regionkey = r_regionkey")
def prj_lower_columns(t: Tables) -> DataFrame:
    rows = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_regionkey").alias("R_REGIONKEY"), F.col("r_name").alias("R_Name"),
        F.col("n_nationkey").alias("N_NationKey"), F.col("n_name").alias("n_NAME"),
    )
    return C.lower_names(rows)


@query("""
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS VARCHAR) AS c_mktsegment, c_name AS start_note FROM customer""")
def prj_schema_evolve(t: Tables) -> DataFrame:
    stored = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", F.col("c_name").alias("start_note"))
    source = t.customer.select("c_custkey", F.col("c_nationkey").cast("bigint").alias("c_nationkey"), "c_mktsegment")
    return C.evolve_to(stored, source.schema, ["start_note"])


@query(f"""WITH {X.INVENTORY}
SELECT pipeline_id, CASE domain_name WHEN 'finance' THEN 'Money' WHEN 'ratings' THEN 'Grades' WHEN 'reference' THEN 'Lists' ELSE domain_name END
  AS domain_name FROM inventory""")
def prj_label_map(t: Tables) -> DataFrame:
    return C.map_labels(X.inventory(t).select("pipeline_id", "domain_name"), "domain_name", X.LABELS)


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]
_NAMES = dict(zip(_TYPES, ["bigint", "decimal(12,2)", "datetime", "varchar(30)", "array<int>"]))


@query(f"""
WITH r AS (SELECT p_partkey, CASE p_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _NAMES.items())} ELSE 'boolean' END AS kind FROM part),
b AS (SELECT p_partkey, kind, regexp_replace(kind, '\\(.*$', '') AS base FROM r)
SELECT p_partkey, CASE base WHEN 'bigint' THEN 'Whole Number' WHEN 'decimal' THEN 'Decimal Number' WHEN 'datetime' THEN 'Date Time'
  WHEN 'varchar' THEN 'Text' WHEN 'boolean' THEN 'True/False' ELSE kind END AS kind FROM b""")
def prj_type_labels(t: Tables) -> DataFrame:
    return C.label_types(t.part.select("p_partkey", X.cases("p_type", _NAMES, "boolean").alias("kind")), "kind")


@query("""
SELECT p_partkey, 'name_' || p_size AS col_name, 'string' AS col_type FROM part
UNION ALL SELECT p_partkey, p_type AS col_name, 'int' AS col_type FROM part""")
def prj_explode_pairs(t: Tables) -> DataFrame:
    pairs = F.array(
        F.concat(F.lit("('name_"), "p_size", F.lit("', 'string')")), F.concat(F.lit("('"), "p_type", F.lit("', 'int')"))
    )
    return C.explode_pairs(t.part.select("p_partkey", pairs.alias("cols")), "cols")


@query(f"""WITH {X.NULLABLE}
SELECT CAST(o_orderkey AS VARCHAR) || '|' || COALESCE(priority, '') || '|' || COALESCE(CAST(custkey AS VARCHAR), '') AS "FullKey",
       o_orderkey, priority, custkey FROM nullable""")
def prj_full_key(t: Tables) -> DataFrame:
    return C.full_row_key(X.nullable_orders(t).select("o_orderkey", "priority", "custkey"))


@query("SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey")
def prj_to_dict(t: Tables) -> DataFrame:
    return C.last_value_by_key(t.orders, "o_custkey", "o_orderpriority", "o_orderkey")


@query("SELECT DISTINCT l_partkey FROM lineitem")
def prj_distinct_values(t: Tables) -> DataFrame:
    return C.distinct_values(t.lineitem, "l_partkey")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS pipeline_id, 's3://prd-' || o_orderstatus || '/data/final' AS location FROM orders")
def prj_select_environment(t: Tables) -> DataFrame:
    rows = C.select_environment(X.inventory(t), "target_environments", "PROD", prefix="s3://")
    return rows.select("pipeline_id", "location")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
       '{"brand":"' || p_brand || '","size":' || p_size || '}' AS info,
       '["' || p_type || '","' || p_brand || '"]' AS tags FROM part""")
def prj_to_json_columns(t: Tables) -> DataFrame:
    rows = t.part.select(
        "p_partkey", "p_name",
        F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("info"),
        F.array("p_type", "p_brand").alias("tags"),
    )
    return C.to_json_columns(rows)


# --------------------------------------------------------------------- filters


@query("SELECT * FROM lineitem WHERE l_quantity >= 25 AND l_returnflag = 'R'")
def flt_select_rows(t: Tables) -> DataFrame:
    return filters.select_rows(t.lineitem, "l_quantity >= 25 AND l_returnflag = 'R'")


@query("""
SELECT o_orderkey, o_orderdate, l_shipdate FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1998-06-30 00:00:00'
   OR l_shipdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1998-06-30 00:00:00'""")
def flt_incremental(t: Tables) -> DataFrame:
    rows = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    picked = filters.incremental_filter(
        rows.select("o_orderkey", "o_orderdate", "l_shipdate"), ["o_orderdate", "l_shipdate"],
        dt.datetime(1997, 1, 1), dt.datetime(1998, 6, 30),
    )
    return picked


@query(f"""WITH {X.DIMENSION}
SELECT entity_id, issuer_num, CAST(end_dtm AS DATE) AS end_dt FROM dimension WHERE CAST(end_dtm AS DATE) = DATE '9999-12-31'""")
def flt_current_rows(t: Tables) -> DataFrame:
    rows = X.dated_customers(t).select("entity_id", "issuer_num", F.col("end_dtm").cast("date").alias("end_dt"))
    return filters.current_rows(rows, open_end=dt.date(9999, 12, 31))


@query(f"WITH {X.INVENTORY} SELECT pipeline_id, domain_name FROM inventory WHERE active = 'true' AND status = 'published'")
def flt_active_published(t: Tables) -> DataFrame:
    return filters.active_published(X.inventory(t)).select("pipeline_id", "domain_name")


@query("SELECT * FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')")
def flt_delete_by_key(t: Tables) -> DataFrame:
    gone = t.part.filter(F.col("p_type") == "PROMO").select("p_partkey")
    return filters.delete_by_key(t.lineitem, "l_partkey", gone)


# ------------------------------------------------------------------- functions


@query(f"""WITH {X.NULLABLE}
SELECT o_orderkey, md5(o_orderstatus) AS hub,
       md5(concat_ws(',', COALESCE(LENGTH(priority) || ':' || priority, '-'),
                          COALESCE(LENGTH(CAST(custkey AS VARCHAR)) || ':' || CAST(custkey AS VARCHAR), '-'))) AS safe,
       md5(concat_ws(',', priority, CAST(custkey AS VARCHAR))) AS legacy FROM nullable""")
def fn_hash_keys(t: Tables) -> DataFrame:
    return X.nullable_orders(t).select(
        "o_orderkey", F.md5("o_orderstatus").alias("hub"), row_hash(["priority", "custkey"]).alias("safe"),
        row_hash(["priority", "custkey"], legacy=True, separator=",").alias("legacy"),
    )


@query("""
SELECT doc_id, concat_ws('|', lang, source) AS tag, regexp_replace(source, 'src', 's', 'g') AS short,
       split_part(source, 'c', 2) AS number, translate(lang, 'ef', 'EF') AS swapped, LOWER(text) AS lowered,
       starts_with(source, 'src1') AS first_block, lang || ':' || source AS joined FROM documents""")
def fn_string_ops(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        F.concat_ws("|", "lang", "source").alias("tag"),
        F.regexp_replace("source", "src", "s").alias("short"),
        F.split("source", "c").getItem(1).alias("number"),
        F.translate("lang", "ef", "EF").alias("swapped"),
        F.lower("text").alias("lowered"),
        F.col("source").startswith("src1").alias("first_block"),
        F.concat("lang", F.lit(":"), "source").alias("joined"),
    )


@query("""
SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) - 1 AS before, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text,
       date_trunc('year', CAST(ts AS DATE)) = DATE '2024-01-01' AS in_2024,
       CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS parsed FROM events""")
def fn_date_ops(t: Tables) -> DataFrame:
    day = F.col("ts").cast("date")
    return t.events.select(
        "event_id", day.alias("day"), F.date_sub(day, 1).alias("before"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"),
        (F.trunc(day, "year") == F.lit(dt.date(2024, 1, 1))).alias("in_2024"),
        F.date_format("ts", "yyyy-MM-dd").cast("date").alias("parsed"),
    )


@query("""
WITH r AS (SELECT p_partkey, [p_brand, CASE WHEN p_size > 25 THEN p_type ELSE '' END, p_name] AS a FROM part)
SELECT p_partkey, array_to_string(list_filter(a, lambda x: x <> ''), ';') AS kept,
       CAST(len(list_filter(a, lambda x: x <> '')) AS INTEGER) AS n FROM r""")
def fn_array_ops(t: Tables) -> DataFrame:
    parts = F.array("p_brand", F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(""), "p_name")
    kept = F.array_remove(parts, "")
    return t.part.select("p_partkey", F.array_join(kept, ";").alias("kept"), F.size(kept).alias("n"))


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS packed FROM events""")
def fn_json_ops(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", F.from_json("props", "k int")["k"].alias("k"), F.to_json(F.struct("event_id", "event_type")).alias("packed")
    )


@query(f"""WITH {X.NULLABLE}
SELECT o_orderkey, COALESCE(priority, 'none') AS priority, COALESCE(custkey, -1) AS custkey,
       NULLIF(o_orderstatus, 'F') AS status, CASE WHEN priority IS NULL THEN 'open' ELSE 'set' END AS state FROM nullable""")
def fn_map_nulls(t: Tables) -> DataFrame:
    rows = X.nullable_orders(t)
    return rows.select(
        "o_orderkey",
        F.coalesce("priority", F.lit("none")).alias("priority"),
        F.coalesce("custkey", F.lit(-1)).alias("custkey"),
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.when(F.col("priority").isNull(), "open").otherwise("set").alias("state"),
    )
