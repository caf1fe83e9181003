"""Quality, lineage, catalogue and run-log queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import catalog, digests, lineage, quality, runlog, states
from millrace.operators import columns as C
from millrace.operators.joins import left_join
from millrace.operators.sets import union_many
from millrace.queries import fixtures as X
from millrace.queries.groups import part_sql
from millrace.queries.registry import ORACLE, Tables, query
from millrace.scratch import stage, work_dir
from millrace.sources.files import json_records

RULES = [
    ("isComplete()", "o_orderkey", "key present"),
    ("isComplete()", "priority", "priority present"),
    ("hasCompleteness(0.5)", "custkey", "customer mostly present"),
    ("isUnique()", "o_orderkey", "key unique"),
    ("isUnique()", "custkey", "one order each"),
    ("isNonNegative()", "o_orderkey", "no negative key"),
    ("isPositive()", "o_orderkey", "positive key"),
    ("hasMin(0)", "custkey", "lower bound"),
    ("hasMax(10)", "custkey", "upper bound"),
    ("isContainedIn(['F', 'O', 'P'])", "o_orderstatus", "known state"),
    ("isContainedIn(['F', 'O'], 0.9)", "o_orderstatus", "mostly closed"),
    ("hasPattern('^[0-9]-')", "priority", "numbered"),
    ("hasDataType('int')", "priority", "whole number"),
    ("satisfies('custkey >= 0')", "custkey", "sane customer"),
]


# rules that are read from sketches; their bounds hold at every scale
SKETCH_RULES = [
    ("hasApproxCountDistinct(2, 4)", "o_orderstatus", "few states"),
    ("hasApproxQuantile(0.5, 0, 1000000000000)", "o_orderkey", "middle key"),
]


def _rules(listed: list[tuple] = RULES) -> list[quality.Rule]:
    return [quality.parse_rule(text, column, note, allow_sql=True) for text, column, note in listed]


# all but uniqueness, for which states of parts do not suffice
STATE_RULES = [r for r in RULES if not r[0].startswith("isUnique")] + SKETCH_RULES


def _verify_sql(stored: bool = False) -> str:
    def share(hit: str, base: str, least: str = "1") -> str:
        hits, total = f"COUNT(*) FILTER (WHERE ({base}) AND ({hit}))", f"COUNT(*) FILTER (WHERE {base})"
        return f"{hits} AS hits, {total} AS total, hits >= {least} * total AS ok, {cut} AS m FROM nullable"

    def once(column: str) -> str:
        counts = f"SELECT COUNT(*) AS n FROM nullable WHERE {column} IS NOT NULL GROUP BY {column}"
        return f"COUNT(*) FILTER (WHERE n = 1) AS hits, COALESCE(SUM(n), 0) AS total, hits = total AS ok, {cut} AS m FROM ({counts})"

    def bound(metric: str, test: str) -> str:
        return f"0 AS hits, 0 AS total, {metric} {test} AS ok, CAST(CAST({metric} AS DECIMAL(18,6)) AS VARCHAR) AS m FROM nullable"

    cut = "CAST(CAST(COALESCE(hits / NULLIF(CAST(total AS DOUBLE), 0), 1) AS DECIMAL(18,6)) AS VARCHAR)"
    metrics = [
        share("o_orderkey IS NOT NULL", "TRUE"),
        share("priority IS NOT NULL", "TRUE"),
        share("custkey IS NOT NULL", "TRUE", "0.5"),
        once("o_orderkey"),
        once("custkey"),
        bound("MIN(o_orderkey)", ">= 0"),
        bound("MIN(o_orderkey)", "> 0"),
        bound("MIN(custkey)", ">= 0"),
        bound("MAX(custkey)", "<= 10"),
        share("o_orderstatus IN ('F','O','P')", "o_orderstatus IS NOT NULL"),
        share("o_orderstatus IN ('F','O')", "o_orderstatus IS NOT NULL", "0.9"),
        share("regexp_matches(priority, '^[0-9]-')", "priority IS NOT NULL"),
        share("TRY_CAST(priority AS INTEGER) IS NOT NULL", "priority IS NOT NULL"),
        share("COALESCE(custkey >= 0, FALSE)", "TRUE"),
    ]
    if stored:
        metrics = [m for m, r in zip(metrics, RULES) if not r[0].startswith("isUnique")]
        metrics.append("0 AS hits, 0 AS total, COUNT(DISTINCT o_orderstatus) BETWEEN 2 AND 4 AS ok, '' AS m FROM nullable")
        metrics.append("0 AS hits, 0 AS total, MEDIAN(o_orderkey) BETWEEN 0 AND 1000000000000 AS ok, '' AS m FROM nullable")
    rows = []
    for rule, metric in zip(_rules(STATE_RULES if stored else RULES), metrics):
        text = rule.text.replace("'", "''")
        rows.append(
            f"SELECT '{rule.column}' AS column_name, '{text}' AS dq_rule, '{rule.description}' AS dq_rule_description, "
            f"'{rule.name}({rule.column})' AS constraint, ok, m FROM (SELECT {metric})"
        )
    return f"""WITH {X.NULLABLE}, results AS ({' UNION ALL '.join(rows)})
SELECT column_name, dq_rule, dq_rule_description, "constraint", CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS constraint_status,
       CASE WHEN ok THEN '' ELSE 'Value: ' || m END AS constraint_message FROM results"""


@query(_verify_sql())
def dq_verify(t: Tables) -> DataFrame:
    return quality.verify(X.nullable_orders(t), _rules())


@query(_verify_sql(stored=True))
def dq_verify_states(t: Tables) -> DataFrame:
    """The same rules from states that are stored for every order status, sketches included."""
    orders, rules, path = X.nullable_orders(t), _rules(STATE_RULES), work_dir(t.spark, "states")
    known = stage(states.measure(orders, rules, by="o_orderstatus"), "states")
    for status in ("F", "O", "P"):
        states.store_states(known.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), path, status)
    return states.verify_states(states.read_states(t.spark, path), rules, orders.schema)


def _profile_sql(distinct: bool = False) -> str:
    columns = [
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("day", "string"), ("priority", "string"),
    ]
    rows = []
    for c, kind in columns:
        number, text = kind == "bigint", kind == "string"
        ends = [f"CAST({f}({c}) AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)" for f in ("MIN", "MAX")]
        parsed = {n: f"CAST(COUNT(TRY_CAST({c} AS {n})) AS BIGINT)" if text else "CAST(0 AS BIGINT)" for n in ("bigint", "double", "date")}
        flags = "'t','true','y','yes','1','f','false','n','no','0'"
        parsed["boolean"] = f"CAST(COUNT(*) FILTER (WHERE LOWER(TRIM({c})) IN ({flags})) AS BIGINT)" if text else "CAST(0 AS BIGINT)"
        rows.append(
            f"SELECT '{c}' AS column_name, '{kind}' AS data_type, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT({c}) AS BIGINT) AS non_null, "
            f"{ends[0]} AS min_value, {ends[1]} AS max_value, " + ", ".join(f"{v} AS as_{n}" for n, v in parsed.items())
            + (f", COUNT(DISTINCT {c}) AS dist" if distinct else "") + " FROM src"
        )
    return """WITH src AS (SELECT o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day,
  CASE WHEN o_orderstatus <> 'P' THEN SUBSTR(o_orderpriority, 1, 1) END AS priority FROM orders)
SELECT * FROM (""" + " UNION ALL ".join(rows) + ")"


def _profiled(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    priority = F.when(F.col("o_orderstatus") != "P", F.substring("o_orderpriority", 1, 1)).alias("priority")
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", day, priority)


@query(_profile_sql())
def dq_profile(t: Tables) -> DataFrame:
    return quality.profile(_profiled(t), distinct=False)


def _suggest_sql() -> str:
    floor = "FLOOR((share - 1.96 * SQRT(share * (1 - share) / rows)) * 100) / 100"
    part = f"CAST(CAST({floor} AS DECIMAL(4,2)) AS VARCHAR)"
    rules = [
        ("isComplete", "non_null = rows", "NULL", "' is not null'"),
        ("hasCompleteness", "share > 0.2 AND share < 1", part,
         f"' has less than ' || CAST(ROUND((1 - {floor}) * 100) AS INTEGER) || '% missing values'"),
        ("isNonNegative", "min_value >= 0", "NULL", "' has no negative values'"),
        ("hasDataType", "data_type = 'string' AND non_null > 0 AND narrow IS NOT NULL", "chr(39) || narrow || chr(39)", "' has type ' || narrow"),
        ("isUnique", "non_null = rows AND dist >= 0.92 * rows", "NULL", "' is unique'"),
    ]
    rows = [
        f"SELECT column_name AS source_col_name, '{name}' AS rule, chr(39) || column_name || chr(39) || {text} AS dq_suggestion_result, "
        f"'.{name}(' || chr(34) || column_name || chr(34) || COALESCE(', ' || {extra}, '') || ')' AS dq_rule FROM p WHERE rows > 0 AND {when}"
        for name, when, extra, text in rules
    ]
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS c, {c} AS v FROM src WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("o_orderstatus", "day", "priority")
    )
    lists = f"SELECT c, string_agg(chr(39) || v || chr(39), ', ' ORDER BY v) AS vs FROM ({values}) GROUP BY c HAVING COUNT(*) <= 5"
    rows.append(
        f"SELECT c, 'isContainedIn', chr(39) || c || chr(39) || ' has value range ' || vs, "
        f"'.isContainedIn(' || chr(34) || c || chr(34) || ', [' || vs || '])' FROM ({lists})"
    )
    source, _, body = _profile_sql(distinct=True).partition(")\nSELECT * FROM (")
    narrow = "CASE " + " ".join(f"WHEN as_{n} = non_null THEN '{n}'" for n in ("bigint", "double", "date", "boolean")) + " END"
    return f"{source}), p AS (SELECT *, CAST(non_null AS DOUBLE) / rows AS share, {narrow} AS narrow FROM ({body}) " + " UNION ALL ".join(rows)


@query(_suggest_sql())
def dq_suggest(t: Tables) -> DataFrame:
    """All rules; uniqueness rests on an approximate count, off by one per cent."""
    return quality.suggest(_profiled(t), list_values=5)


@query("WITH src AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS exact, TRUE AS near FROM src" for c in ("o_orderkey", "o_custkey", "day")))
def dq_distinct_bounds(t: Tables) -> DataFrame:
    """Approximate distinct counts of a profile lie within five per cent of the exact ones."""
    rows, columns = _profiled(t), ["o_orderkey", "o_custkey", "day"]
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in columns])
    counts = exact.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("exact")) for c in columns])).alias("e")).select("e.*")
    both = quality.profile(rows, columns).select("column_name", "approx_distinct").join(counts, "column_name")
    return both.select("column_name", "exact", (F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.05 * F.col("exact")).alias("near"))


@query("""
WITH src AS (
  SELECT CASE WHEN l_linenumber = 7 THEN 'odd ' || l_orderkey ELSE l_returnflag || l_linestatus END AS state,
         l_orderkey || '-' || l_linenumber AS line FROM lineitem),
c AS (SELECT 'state' AS name, state AS v, COUNT(*) AS n FROM src GROUP BY state UNION ALL SELECT 'line', line, COUNT(*) FROM src GROUP BY line),
f AS (SELECT *, (SELECT COUNT(*) FROM src) AS total FROM c),
b AS (SELECT *, COALESCE(SUM(n) OVER (PARTITION BY name ORDER BY n DESC, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM f WHERE n >= 0.005 * total),
l AS (SELECT name, total, SUM(n) AS covered, string_agg(chr(39) || v || chr(39), ', ' ORDER BY n DESC, v) AS vs
      FROM b WHERE before < 0.9 * total GROUP BY name, total HAVING SUM(n) >= 0.9 * total AND SUM(n) < total),
s AS (SELECT *, CAST(covered AS DOUBLE) / total AS part FROM l),
r AS (SELECT *, FLOOR((part - SQRT(part * (1 - part) / total) * 1.96) * 100) / 100 AS least FROM s)
SELECT name AS source_col_name, 'isContainedIn' AS rule,
       chr(39) || name || chr(39) || ' has value range ' || vs || ' for at least ' || CAST(least * 100 AS INTEGER) || '% of values' AS dq_suggestion_result,
       '.isContainedIn(' || chr(34) || name || chr(34) || ', [' || vs || '], ' || CAST(CAST(least AS DECIMAL(4,2)) AS VARCHAR) || ')' AS dq_rule
FROM r""")
def dq_suggest_frequent(t: Tables) -> DataFrame:
    """Values that make up nine tenths of a column with many others; a column of keys has none."""
    state = F.when(F.col("l_linenumber") == 7, F.concat(F.lit("odd "), "l_orderkey")).otherwise(F.concat("l_returnflag", "l_linestatus"))
    lines = t.lineitem.select(state.alias("state"), F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("line"))
    return quality.suggest(lines, list_share=0.9).where("rule = 'isContainedIn'")


def _compared(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders against a copy with changed prices, statuses and a null-against-value case."""
    source = X.orders_typed(t)
    priority = F.col("o_orderpriority")
    target = source.filter(priority != "5-LOW").select(
        "o_orderkey",
        "o_custkey",
        F.when(priority == "1-URGENT", F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
        .cast("decimal(15,2)").alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    return source.filter(priority != "3-MEDIUM"), target


@query(f"""WITH {X.ORDERS}
SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS o_orderstatus,
       CAST(o_totalprice + 1 AS DECIMAL(15,2)) AS o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'o_orderstatus,o_totalprice' ELSE 'o_totalprice' END AS column_names
FROM orders_typed WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def dq_cell_diff(t: Tables) -> DataFrame:
    diff = quality.cell_diff(*_compared(t), "o_orderkey")
    return diff.withColumn("column_names", F.array_join("column_names", ","))


@query(ORACLE["dq_cell_diff"])
def dq_tree_diff(t: Tables) -> DataFrame:
    """The same by a tree of digests."""
    return digests.tree_diff(*_compared(t), "o_orderkey").withColumn("column_names", F.array_join("column_names", ","))


@query("""
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 'target' ELSE 'source' END AS missing_in
FROM orders WHERE o_orderpriority IN ('5-LOW', '3-MEDIUM')""")
def dq_tree_missing(t: Tables) -> DataFrame:
    return digests.tree_missing(*_compared(t), "o_orderkey")


@query("""
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 'target' ELSE 'source' END AS missing_in
FROM orders WHERE o_orderpriority IN ('5-LOW', '3-MEDIUM')""")
def dq_missing_keys(t: Tables) -> DataFrame:
    return quality.missing_keys(*_compared(t), "o_orderkey")


@query(f"""WITH {X.COLUMN_RECORDS}, f AS (
  SELECT pipeline_id, sequence_number, column_id, source_datatype, target_datatype,
         CASE source_datatype WHEN 'int' THEN 'number' ELSE 'string' END AS source_family,
         CASE target_datatype WHEN 'decimal' THEN 'number' WHEN 'string' THEN 'string' ELSE 'date' END AS target_family FROM column_records)
SELECT *, source_family = target_family AS same_family FROM f""")
def dq_type_families(t: Tables) -> DataFrame:
    rows = X.column_records(t).select("pipeline_id", "sequence_number", "column_id", "source_datatype", "target_datatype")
    return quality.type_family_diff(rows)


@query("""
WITH r AS (
  SELECT 'customer' AS table_name, COUNT(*) FILTER (WHERE c_acctbal < 0) > 0 AS bad FROM customer
  UNION ALL SELECT 'customer', COUNT(DISTINCT c_nationkey) < COUNT(c_nationkey) FROM customer
  UNION ALL SELECT 'orders', COUNT(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) > 0 FROM orders
  UNION ALL SELECT 'orders', COUNT(DISTINCT o_orderkey) < COUNT(o_orderkey) FROM orders
  UNION ALL SELECT 'part', COUNT(*) FILTER (WHERE p_size > 50) > 0 FROM part
  UNION ALL SELECT 'lineitem', COUNT(*) FILTER (WHERE l_quantity < 1) > 0 FROM lineitem)
SELECT table_name, CAST(COUNT(*) AS BIGINT) AS failed_rules FROM r WHERE bad GROUP BY 1""")
def dq_all_tables(t: Tables) -> DataFrame:
    R = quality.Rule
    results = quality.verify_tables({
        "customer": (t.customer, [R("isNonNegative", "c_acctbal"), R("isUnique", "c_nationkey")]),
        "orders": (t.orders, [R("isContainedIn", "o_orderstatus", (["F", "O"],)), R("isUnique", "o_orderkey")]),
        "part": (t.part, [R("hasMax", "p_size", (50,))]),
        "lineitem": (t.lineitem, [R("hasMin", "l_quantity", (1,))]),
    })
    return quality.failed_tables(results)


# --------------------------------------------------------------------- lineage


@query(""" WITH e AS (
  SELECT 'order:' || o_orderkey AS target, 'customer:' || o_custkey AS mid FROM orders)
SELECT e.target, 'region:' || n_regionkey AS root FROM e JOIN customer ON e.mid = 'customer:' || c_custkey JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'customer:' || c_custkey, 'region:' || n_regionkey FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation""")
def lin_root_sources(t: Tables) -> DataFrame:
    def edge(df: DataFrame, kind: str, key: str, parent: str, ref: str) -> DataFrame:
        return df.select(F.concat(F.lit(f"{kind}:"), key).alias("target"), F.concat(F.lit(f"{parent}:"), ref).alias("source"))

    edges = edge(t.orders, "order", "o_orderkey", "customer", "o_custkey")
    edges = edges.unionByName(edge(t.customer, "customer", "c_custkey", "nation", "c_nationkey"))
    edges = edges.unionByName(edge(t.nation, "nation", "n_nationkey", "region", "n_regionkey"))
    return lineage.root_sources(edges)


AT = dt.datetime(2024, 1, 1)


@query()
def lin_events(t: Tables) -> DataFrame:
    """Event log of the recorded steps with the size of every dataset they made."""
    log = lineage.LineageLog("orders_report", "finance")
    orders = log.apply(C.rename, {"orders": t.orders}, "orders_renamed", AT, {"o_custkey": "c_custkey"},
                       details={"renamed_cols": {"o_custkey": "c_custkey"}})
    joined = log.apply(left_join, {"orders_renamed": orders, "customer": t.customer}, "orders_customers", AT, "c_custkey",
                       details={"key_cols": ["c_custkey"]})
    slim = log.apply(C.cut_out, {"orders_customers": joined}, "orders_report", AT, ["c_acctbal"])
    log.finish(slim, "orders_report", "data/final/orders_report", AT, ["orders_customers"])
    made = {"orders_renamed": orders, "orders_customers": joined, "orders_report": slim}
    named = [df.select(F.lit(n).alias("target_tables")) for n, df in made.items()]
    sizes = union_many(named).groupBy("target_tables").agg(F.count(F.lit(1)).alias("rows"))
    return log.to_frame(t.spark).join(sizes, "target_tables")


@query("""
SELECT o_orderpriority, CAST(COUNT(*) AS BIGINT) AS lines, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def lin_spark_sql(t: Tables) -> DataFrame:
    log = lineage.LineageLog("report", "finance")
    return log.sql(
        t.spark,
        "SELECT o_orderpriority, COUNT(*) AS lines, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS quantity "
        "FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey GROUP BY o_orderpriority",
        {"orders": t.orders, "lineitem": t.lineitem}, "priority_report", AT,
    )


# ------------------------------------------------------------------- catalogue


_DOMAIN = "CASE domain_name WHEN 'finance' THEN 'Money' WHEN 'ratings' THEN 'Grades' WHEN 'reference' THEN 'Lists' ELSE domain_name END"
_KIND = """CASE datatype WHEN 'timestamp' THEN 'Date Time' WHEN 'datetime' THEN 'Date Time' WHEN 'date' THEN 'Date' WHEN 'string' THEN 'Text'
  WHEN 'varchar' THEN 'Text' WHEN 'char' THEN 'Text' WHEN 'int' THEN 'Whole Number' WHEN 'bigint' THEN 'Whole Number'
  WHEN 'smallint' THEN 'Whole Number' WHEN 'boolean' THEN 'True/False' WHEN 'decimal' THEN 'Decimal Number'
  WHEN 'bigdecimal' THEN 'Decimal Number' WHEN 'double' THEN 'Decimal Number' ELSE datatype END"""
_ORDER = "column_id, datatype, target_length NULLS FIRST, target_precision NULLS FIRST, target_datetime_format NULLS FIRST"


@query(f"""WITH {X.INVENTORY}, {X.COLUMN_RECORDS},
inv AS (SELECT pipeline_id, {_DOMAIN} AS domain_name, pipeline_desc, target_file_name AS table_name,
               's3://dev-' || SUBSTR(app_name, 5) || '/data/final' AS location
        FROM inventory WHERE active = 'true' AND status = 'published'),
cls AS (SELECT p_partkey AS column_id, p_type AS classification_level, p_name AS business_description FROM part WHERE p_type <> 'PROMO'),
r AS (SELECT *, LOWER(target_datatype) AS datatype FROM column_records LEFT JOIN cls USING (column_id) JOIN inv USING (pipeline_id)),
one AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY domain_name, table_name, target_column_name ORDER BY {_ORDER}) AS n FROM r) WHERE n = 1),
filled AS (SELECT *, COALESCE(classification_level, 'INTERNAL') AS cl, COALESCE(target_length, '0') AS len FROM one)
SELECT table_name AS "Full Name", table_name AS "Name", domain_name AS "Community", 'Physical Data Dictionary' AS "Domain Type",
       'Raw' AS "Domain", 'Table' AS "Asset Type", '' AS "Data Type", '' AS "Data Type Precision", '' AS "Size",
       '' AS "Data Classification", location || '/' || table_name AS "File Location", '' AS "Format", pipeline_desc AS "Description",
       '' AS "is part of [Table] > Name", '' AS "is part of [Table] > Full Name", '' AS "is part of [Table] > Community",
       '' AS "is part of [Table] > Domain" FROM (SELECT DISTINCT domain_name, table_name, pipeline_desc, location FROM filled)
UNION ALL
SELECT target_column_name || ' > ' || table_name, target_column_name, domain_name, 'Physical Data Dictionary', 'Raw', 'Column',
       {_KIND}, target_precision, len, cl, '', target_datetime_format, business_description, table_name,
       target_column_name || ' > ' || table_name, domain_name, 'Raw' FROM filled""")
def cat_raw_feed(t: Tables) -> DataFrame:
    classified = t.part.filter(F.col("p_type") != "PROMO").select(
        F.col("p_partkey").alias("column_id"), F.col("p_type").alias("classification_level"),
        F.col("p_name").alias("business_description"),
    )
    return catalog.raw_feed(X.inventory(t), X.column_records(t), classified, "dev", labels=X.LABELS, prefix="s3://")


@query("""
WITH f AS (SELECT 'T' || p_partkey AS tgt, CASE p_type WHEN 'ECONOMY' THEN 'Money' WHEN 'PROMO' THEN 'Grades' ELSE 'lab' END AS dom,
                  's3://x/' || p_brand AS path FROM part),
c AS (SELECT tgt, dom, 'Id' AS col, 'Whole Number' AS kind FROM f
      UNION ALL SELECT tgt, dom, 'price', 'Decimal Number' FROM f UNION ALL SELECT tgt, dom, 'seen', 'Date Time' FROM f)
SELECT LOWER(tgt) AS "Full Name", LOWER(tgt) AS "Name", dom AS "Community", 'Physical Data Dictionary' AS "Domain Type",
       'Processed' AS "Domain", 'Table' AS "Asset Type", '' AS "Data Type", '' AS "Data Type Precision", '' AS "Size",
       '' AS "Data Classification", path AS "File Location", '' AS "Format", '' AS "Description",
       '' AS "is part of [Table] > Name", '' AS "is part of [Table] > Full Name", '' AS "is part of [Table] > Community",
       '' AS "is part of [Table] > Domain" FROM f
UNION ALL
SELECT LOWER(col) || ' > ' || tgt, LOWER(col), dom, 'Physical Data Dictionary', 'Processed', 'Column', kind, '', '', '', '', '', '',
       tgt, col || ' > ' || tgt, dom, 'Processed' FROM c""")
def cat_processed_feed(t: Tables) -> DataFrame:
    pairs = ["('Id', 'bigint')", "('price', 'decimal(15,2)')", "('seen', 'timestamp')"]
    done = t.part.select(
        F.concat(F.lit("T"), "p_partkey").alias("target_tables"),
        X.cases("p_type", {"ECONOMY": "finance", "PROMO": "ratings"}, "lab").alias("domain_name"),
        F.concat(F.lit("s3://x/"), "p_brand").alias("final_path"),
        F.array(*[F.lit(p) for p in pairs]).alias("final_df_cols"),
    )
    events = done.withColumn("transformation_func_nm", F.lit("Final")).unionByName(
        done.withColumn("transformation_func_nm", F.lit("rename"))
    )
    return catalog.processed_feed(events, labels=X.LABELS)


@query()
def cat_column_manifest(t: Tables) -> DataFrame:
    """Manifest of a table whose columns come from its JSON texts."""
    return catalog.column_manifest(json_records(t.events.select("event_id", "props"), "props"))


_RECORD = ["sequence_number", "source_column_name", "target_column_name", "column_id"]


# column records of a piece
RECORD_ROWS = 100


@query(f"""WITH {X.INVENTORY}, {X.COLUMN_RECORDS},
paged AS (SELECT *, {part_sql('pipeline_id, version_number', ', '.join(_RECORD), RECORD_ROWS)} AS part FROM column_records),
packed AS (SELECT pipeline_id, version_number, part,
  '[' || string_agg('{{"sequence_number":' || sequence_number || ',"source_column_name":"' || source_column_name || '","target_column_name":"'
    || target_column_name || '","column_id":' || column_id || '}}', ',' ORDER BY sequence_number, column_id) || ']' AS pipeline_columns
  FROM paged GROUP BY 1, 2, 3)
SELECT inventory.*, part, pipeline_columns FROM inventory JOIN packed USING (pipeline_id, version_number)""")
def cat_inventory_pack(t: Tables) -> DataFrame:
    return catalog.pack_inventory(X.inventory(t), X.column_records(t), _RECORD, page_rows=RECORD_ROWS)


@query(ORACLE["cat_inventory_pack"])
def cat_written_inventory(t: Tables) -> DataFrame:
    """The packed records as JSON files, one folder per application, and read back."""
    packed = catalog.pack_inventory(X.inventory(t), X.column_records(t), _RECORD, page_rows=RECORD_ROWS)
    path = work_dir(t.spark, "inventory")
    catalog.write_inventory(packed, path)
    return t.spark.read.schema(packed.schema).json(path).select(*packed.columns)


@query("""
WITH latest AS (SELECT l_orderkey AS pipeline_id, MAX(l_linenumber) AS latest FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
w AS (SELECT o_orderkey AS pipeline_id, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 END AS asked FROM orders),
f AS (SELECT w.pipeline_id, latest, latest IS NOT NULL AND (asked IS NULL OR asked = latest) AS found FROM w LEFT JOIN latest USING (pipeline_id))
SELECT pipeline_id, CASE WHEN found THEN latest END AS version_number, found FROM f""")
def cat_choose_pipelines(t: Tables) -> DataFrame:
    """Every order asks for a pipeline, some for a version of it; lines are the versions."""
    active = F.when(F.col("l_returnflag") != "R", "true").otherwise("false").alias("active")
    inventory = t.lineitem.select(F.col("l_orderkey").alias("pipeline_id"), F.col("l_linenumber").alias("version_number"), active)
    asked = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2)
    return catalog.choose_pipelines(inventory, t.orders.select(F.col("o_orderkey").alias("pipeline_id"), asked.alias("version_number")))


@query("""
SELECT l_orderkey AS pipeline_id, MAX(l_linenumber) AS version_number FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1""")
def cat_latest_versions(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("pipeline_id"), F.col("l_linenumber").alias("version_number"),
        F.when(F.col("l_returnflag") == "R", "false").when(F.col("l_returnflag") == "A", "").alias("active"),
    )
    return catalog.latest_versions(rows)


# --------------------------------------------------------------------- run log


@query(f"""WITH {X.RUNS}
SELECT pipeline_id, arg_max(execution_id, execution_start_dttm) AS execution_id, MAX(execution_start_dttm) AS execution_start_dttm,
       arg_max(job_status, execution_start_dttm) AS job_status FROM runs GROUP BY pipeline_id""")
def run_log_latest(t: Tables) -> DataFrame:
    rows = X.runs(t).select("pipeline_id", "execution_id", "execution_start_dttm", "job_status")
    return runlog.latest_runs(rows, "pipeline_id", "execution_start_dttm")


@query(f"""WITH {X.RUNS}
SELECT pipeline_id, COALESCE(MAX(CASE WHEN job_status = 'SUCCESS' THEN execution_start_dttm END), TIMESTAMP '1900-01-01 00:00:00') AS fetch_from
FROM runs GROUP BY pipeline_id""")
def ord_last_success(t: Tables) -> DataFrame:
    return runlog.last_success(X.runs(t), "pipeline_id")


@query(f"""WITH {X.RUNS}
SELECT execution_id, CASE WHEN COALESCE(sla, '') = '' THEN 'not applicable'
  WHEN date_diff('microsecond', execution_start_dttm, execution_end_dttm) < 1000000 * (CAST(split_part(sla, ':', 1) AS BIGINT) * 3600
       + CAST(split_part(sla, ':', 2) AS INTEGER) * 60 + CAST(split_part(sla, ':', 3) AS INTEGER)) THEN 'true' ELSE 'false' END AS sla_met
FROM runs""")
def run_sla(t: Tables) -> DataFrame:
    rows = runlog.sla_met(X.runs(t), "execution_start_dttm", "execution_end_dttm", "sla")
    return rows.select("execution_id", "sla_met")


@query(f"""WITH {X.RUNS}
SELECT execution_id, CASE WHEN COALESCE(ola, '') = '' THEN FALSE
  ELSE CAST(execution_start_dttm AS TIME) BETWEEN CAST(split_part(ola, '-', 1) AS TIME) AND CAST(split_part(ola, '-', 2) AS TIME) END AS blocked
FROM runs""")
def run_ola(t: Tables) -> DataFrame:
    return runlog.ola_blocked(X.runs(t), "execution_start_dttm", "ola").select("execution_id", "blocked")
