"""End-to-end job queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import exclude_quarantined
from millrace.plans import fees
from millrace.plans.chains import scd2_chain
from millrace.plans.config import Ingestion
from millrace.plans.ingest import backfill, run_ingest
from millrace.plans.ratings import OWN_FORMS, SOURCES, RatingSource, consolidate, current_ratings
from millrace.queries import fixtures as X
from millrace.queries.changes import _CHAIN_SQL, CHAIN, chain_sources
from millrace.queries.registry import ORACLE, Tables, query
from millrace.scratch import work_dir
from millrace.sinks.versions import read_version
from millrace.sources.targets import read_latest_partition

AS_OF = dt.datetime(2025, 3, 4, 5, 6, 7)

ORDER_RECORD = {
    "pipeline_id": "orders-daily",
    "app_name": "orders",
    "domain_name": "finance",
    "load_type": "full",
    "target_file_name": "orders",
    "primary_key_set": "['order_id']",
    "log_chng_indicator_key": "",
    "target_partition_col": "",
    "pipeline_columns": [
        {"sequence_number": "1", "source_column_name": "o_orderkey", "target_column_name": "order_id", "target_datatype": "bigint"},
        {"sequence_number": "2", "source_column_name": "o_custkey", "target_column_name": "customer_id", "target_datatype": "string"},
        {"sequence_number": "3", "source_column_name": "o_totalprice", "target_column_name": "price", "target_datatype": "decimal",
         "target_length": "15", "target_precision": "2"},
        {"sequence_number": "4", "source_column_name": "o_orderdate", "target_column_name": "ordered_at", "target_datatype": "date"},
    ],
}

_TYPED = "SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_totalprice AS price, o_orderdate AS ordered_at FROM "


@query(f"WITH {X.TARGET} {_TYPED} target")
def job_ingest_full(t: Tables) -> DataFrame:
    base = work_dir(t.spark, "ingest")
    result = run_ingest(t.spark, Ingestion.from_record(ORDER_RECORD), base, AS_OF, source=X.order_target(t))
    return t.spark.read.parquet(result.final_path)


@query(f"""{X.WITH_CHANGES}
{_TYPED} target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes WHERE op IS NOT NULL)
UNION ALL {_TYPED} changes WHERE op IN ('INS', 'UPD')""")
def job_ingest_delta(t: Tables) -> DataFrame:
    """First load, then an increment with change indicators."""
    base = work_dir(t.spark, "ingest")
    record = {**ORDER_RECORD, "load_type": "delta"}
    run_ingest(t.spark, Ingestion.from_record(record), base, AS_OF, source=X.order_target(t))
    marked = Ingestion.from_record({**record, "log_chng_indicator_key": "['op']"})
    result = run_ingest(t.spark, marked, base, AS_OF + dt.timedelta(days=1), source=X.order_changes(t))
    return t.spark.read.parquet(result.final_path)


@query(ORACLE["job_ingest_delta"])
def job_ingest_versioned(t: Tables) -> DataFrame:
    """The same into a versioned table; the increment rewrites only files that hold its keys."""
    base = work_dir(t.spark, "ingest")
    record = {**ORDER_RECORD, "load_type": "delta"}
    run_ingest(t.spark, Ingestion.from_record(record), base, AS_OF, source=X.order_target(t), versioned=True)
    marked = Ingestion.from_record({**record, "log_chng_indicator_key": "['op']"})
    result = run_ingest(t.spark, marked, base, AS_OF + dt.timedelta(days=1), source=X.order_changes(t), versioned=True)
    return read_version(t.spark, result.final_path)


def _twice(t: Tables, record: dict, first: DataFrame, second: DataFrame, days: int = 1) -> str:
    """A first load, then an increment that runs a second time; the stored path."""
    spec, base = Ingestion.from_record({**record, "load_type": "delta"}), work_dir(t.spark, "ingest")
    run_ingest(t.spark, spec, base, AS_OF, source=first)
    for _ in range(2):
        result = run_ingest(t.spark, spec, base, AS_OF + dt.timedelta(days=days), source=second)
    return result.final_path


_INCOMING = "incoming AS (SELECT * FROM changes WHERE op IN ('INS', 'UPD'))"


def _incoming(t: Tables) -> DataFrame:
    return X.order_changes(t).filter(F.col("op").isin("INS", "UPD")).drop("op")


@query(f"""{X.WITH_CHANGES}, {_INCOMING}
{_TYPED} target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming) UNION ALL {_TYPED} incoming""")
def job_ingest_upsert(t: Tables) -> DataFrame:
    """Keyed upsert; the repeated run changes nothing."""
    return t.spark.read.parquet(_twice(t, ORDER_RECORD, X.order_target(t), _incoming(t)))


@query(f"""{X.WITH_CHANGES}, {_INCOMING}
{_TYPED} target UNION ALL {_TYPED} incoming UNION ALL {_TYPED} incoming""")
def job_ingest_append(t: Tables) -> DataFrame:
    """Without keys every increment is added, a repeated one again."""
    return t.spark.read.parquet(_twice(t, {**ORDER_RECORD, "primary_key_set": ""}, X.order_target(t), _incoming(t)))


@query(f"""{X.WITH_CHANGES}, {_INCOMING}
SELECT *, '2025-03-04' AS load_dt FROM ({_TYPED} target) UNION ALL SELECT *, '2025-03-05' FROM ({_TYPED} incoming)""")
def job_ingest_partition(t: Tables) -> DataFrame:
    """One dated partition per run; a repeated run replaces its own."""
    path = _twice(t, {**ORDER_RECORD, "target_partition_col": "load_dt"}, X.order_target(t), _incoming(t))
    stored = t.spark.read.parquet(path)
    return stored.withColumn("load_dt", F.col("load_dt").cast("string"))


@query("""
SELECT event_id AS id, CAST(ts AS TIMESTAMP) AS at, strftime(ts, '%Y-%m-%d') AS load_dt FROM events""")
def job_ingest_backfill(t: Tables) -> DataFrame:
    """Day by day over the whole time of the events, the last days a second time."""
    base = work_dir(t.spark, "ingest")
    ends = t.events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    record = {
        "pipeline_id": "events", "load_type": "delta", "target_file_name": "events", "target_partition_col": "load_dt",
        "cdc_timestamp_key": "['ts']", "source_type": "file", "source_file_path": t.path("events"),
        "pipeline_columns": [
            {"sequence_number": "1", "source_column_name": "event_id", "target_column_name": "id", "target_datatype": "bigint"},
            {"sequence_number": "2", "source_column_name": "ts", "target_column_name": "at", "target_datatype": "timestamp_ntz"},
        ],
    }
    spec = Ingestion.from_record(record)
    backfill(t.spark, spec, base, ends["a"], ends["b"])
    midnight = dt.datetime.combine(ends["b"].date() - dt.timedelta(days=1), dt.time())
    done = backfill(t.spark, spec, base, midnight, ends["b"])
    stored = t.spark.read.parquet(done[-1].final_path)
    return stored.withColumn("load_dt", F.col("load_dt").cast("string"))


def _with_bad_prices(t: Tables) -> DataFrame:
    """The orders as texts; urgent ones have no readable price."""
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"), price.alias("o_totalprice"),
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
    )


@query("""
SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_totalprice AS DECIMAL(15,2)) AS price,
       CAST(o_orderdate AS DATE) AS ordered_at, CAST(NULL AS VARCHAR) AS bad_values FROM orders WHERE o_orderpriority <> '1-URGENT'
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, '{"o_totalprice":"n/a"}' FROM orders WHERE o_orderpriority = '1-URGENT'""")
def job_ingest_errors(t: Tables) -> DataFrame:
    """Good rows as stored, bad ones as the error partition has them: together all orders."""
    base = work_dir(t.spark, "ingest")
    done = run_ingest(t.spark, Ingestion.from_record(ORDER_RECORD), base, AS_OF, source=_with_bad_prices(t), errors=f"{base}/errors")
    wrong = read_latest_partition(t.spark, f"{base}/errors", "load_dt")
    wrong = wrong.select(F.get_json_object("primary_keys", "$.order_id").cast("bigint").alias("order_id"), "bad_values")
    stored = t.spark.read.parquet(done.final_path).withColumn("bad_values", F.lit(None).cast("string"))
    return stored.unionByName(wrong, allowMissingColumns=True)


@query("""
SELECT l_orderkey AS order_id, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority <> '1-URGENT'""")
def job_quarantine_from_errors(t: Tables) -> DataFrame:
    """Lines of orders that the ingestion has set aside are held back."""
    base = work_dir(t.spark, "ingest")
    run_ingest(t.spark, Ingestion.from_record(ORDER_RECORD), base, AS_OF, source=_with_bad_prices(t), errors=f"{base}/errors")
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_id"), "l_linenumber")
    return exclude_quarantined(lines, read_latest_partition(t.spark, f"{base}/errors", "load_dt"), "orders", "order_id")


# --------------------------------------------------------------------- ratings

_FACTS = """classes AS (
  SELECT DISTINCT event_type AS rating_class_cd, UPPER(event_type) AS short_desc, 'class ' || event_type AS long_desc
  FROM events WHERE event_type <> 'view'),
facts AS (
  SELECT event_id, user_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS obj, event_type AS cls, ts,
         CASE WHEN value > 50 THEN 'Y' ELSE 'N' END AS publ FROM events WHERE event_type <> 'error'),
firsts AS (SELECT *, MIN(ts) OVER (PARTITION BY id, obj, cls) AS first_ts FROM facts)"""


def _classes(t: Tables) -> DataFrame:
    kinds = t.events.select("event_type").distinct().filter(F.col("event_type") != "view")
    return kinds.select(
        F.col("event_type").alias("RATING_CLASS_CD"), F.upper("event_type").alias("EVALUATION_TYPE_SHORT_DESC"),
        F.concat(F.lit("class "), "event_type").alias("EVALUATION_TYPE_DESC"),
    )


def _facts(t: Tables, source: RatingSource) -> DataFrame:
    """Every event as a rating of the entity that is its user; errors are closed."""
    closed = F.col("event_type") == "error"
    return t.events.select(
        F.col("user_id").alias(source.fact_id),
        F.from_json("props", "k bigint")["k"].alias("RATING_OBJECT_ID"),
        F.concat(F.lit("R"), "event_id").alias("RATING_TXT"),
        F.col("ts").alias("RATING_DTM"),
        F.col("event_type").alias("RATING_CLASS_CD"),
        F.when(F.col("value") > 50, "Y").otherwise("N").alias("PUBLISH_IND"),
        F.lit("Y").alias("MONITOR_IND"),
        F.col("user_id").alias("RATING_OFFICE_ID"),
        F.concat(F.lit("office "), "user_id").alias("RATING_OFFICE_NM"),
        F.col("ts").alias("EFFT_DTM"),
        F.when(closed, X.ntz("2024-06-01 00:00:00")).otherwise(X.ntz(source.open_end)).alias("END_DTM"),
    )


def _dimension(t: Tables, key: str) -> DataFrame:
    return X.dated_customers(t).select(
        F.col("entity_id").alias(key), F.col("issuer_num").alias("ISSUER_NUM"), F.col("efft_dtm").alias("EFFT_DTM"),
        F.col("term_dtm").alias("TERM_DTM"), F.col("end_dtm").alias("END_DTM"),
    )


def _organizations(t: Tables) -> DataFrame:
    return X.dated_customers(t).select(
        F.col("entity_id").alias("ENTITY_ID"), F.col("issuer_num").alias("ORGANIZATION_ID"),
        F.when(F.col("c_mktsegment") == "FURNITURE", 130).otherwise(129).alias("ORGANIZATION_ROLE_CD"),
        F.col("efft_dtm").alias("EFFT_DTM"), F.col("term_dtm").alias("TERM_DTM"), F.col("end_dtm").alias("END_DTM"),
    )


def _bridge(t: Tables) -> DataFrame:
    record = F.when(F.col("c_acctbal") > 0, "DEAL_POOL_TRANCHE").otherwise("OTHER")
    return t.customer.select(
        F.col("c_custkey").alias("TRANCHE_ID"), F.col("c_nationkey").alias("DEAL_ID"), record.alias("RECORD_TYPE_CD")
    )


def _deals(t: Tables) -> DataFrame:
    region = F.col("n_regionkey")
    return t.nation.select(
        F.col("n_nationkey").alias("DEAL_ID"),
        F.when(region == 0, "151242").otherwise("1").alias("STATUS_CD"),
        F.when(region == 1, X.ntz("2001-01-01 00:00:00")).otherwise(X.ntz("9999-12-31 00:00:00")).alias("END_DTM"),
    )


def _rating(t: Tables, source: RatingSource) -> DataFrame:
    extra = {}
    if source.owner == "dimension":
        extra["dimension"] = _dimension(t, source.fact_id)
    elif source.owner == "organization":
        extra["dimension"] = _organizations(t)
    if source.deals:
        extra.update(bridge=_bridge(t), deals=_deals(t))
    return current_ratings(source, _facts(t, source), _classes(t), AS_OF, **extra)


_VALID = """CAST(end_dtm AS DATE) = DATE '9999-12-31' AND TIMESTAMP '2025-01-01 00:00:00' > efft_dtm
   AND TIMESTAMP '2025-01-01 00:00:00' <= COALESCE(term_dtm, TIMESTAMP '9999-12-31 23:59:59.999')"""


def _rating_select(entity: str, org: str, origin: str, deal: str = "CAST(NULL AS BIGINT)") -> str:
    return f"""SELECT DISTINCT {org} AS "ORG_ID", id AS "INSTR_ID", obj AS "RATFR_ID", {org} || 'D' || id || 'R' || obj AS "UNIQ_RATG_ID",
  '{entity}' AS "ENTITY_TYPE_CD", {deal} AS "DEAL_ID", 'R' || event_id AS "RATG_TXT", ts AS "RATG_DTM", first_ts AS "INIT_RATG_DTM",
  cls AS "RATG_CLASS_CD", publ AS "PUBL_INDC", 'Y' AS "MNTR_INDC", id AS "RATG_OFFC_ID", 'office ' || id AS "RATG_OFFC_NM",
  short_desc AS "EVAL_SHORT_DESC_TXT", long_desc AS "EVAL_DESC_TXT"
FROM firsts LEFT JOIN classes ON rating_class_cd = cls {origin}"""


_OWNED = f"LEFT JOIN dimension ON entity_id = id AND {_VALID}"
_SOLD = f"JOIN dimension ON entity_id = id AND c_mktsegment <> 'FURNITURE' AND {_VALID}"
_DEALS = f"LEFT JOIN (SELECT c_custkey, c_nationkey AS deal_id FROM customer WHERE c_acctbal > 0) b ON b.c_custkey = id {_OWNED}"
_OPEN_DEALS = """LEFT JOIN (SELECT c_custkey, c_nationkey AS deal_id FROM customer WHERE c_acctbal > 0) b ON b.c_custkey = id
LEFT JOIN (SELECT n_nationkey FROM nation WHERE n_regionkey NOT IN (0, 1)) d ON d.n_nationkey = b.deal_id
LEFT JOIN dimension ON entity_id = id AND d.n_nationkey IS NOT NULL AND TIMESTAMP '2025-01-01 00:00:00' > efft_dtm
 AND TIMESTAMP '2025-01-01 00:00:00' <= COALESCE(term_dtm, TIMESTAMP '9999-12-31 23:59:59.999')"""

_SELECTS = {
    "instrument": _rating_select("INSTRUMENT", "issuer_num", _OWNED),
    "program": _rating_select("PROGRAM", "issuer_num", _OWNED),
    "sale": _rating_select("SALE", "issuer_num", _SOLD),
    "organization": _rating_select("ORGANIZATION", "id", ""),
    "tranche": _rating_select("TRANCHE", "issuer_num", _DEALS, "CAST(deal_id AS BIGINT)"),
    "maturity": _rating_select("MATURITY", "issuer_num", _SOLD),
}


@query(f"WITH {X.DIMENSION}, {_FACTS} {_SELECTS['instrument']}")
def job_rating_instrument(t: Tables) -> DataFrame:
    return _rating(t, SOURCES["instrument"])


@query(f"WITH {X.DIMENSION}, {_FACTS} {_SELECTS['program']}")
def job_rating_program(t: Tables) -> DataFrame:
    return _rating(t, SOURCES["program"])


@query(f"WITH {X.DIMENSION}, {_FACTS} {_SELECTS['sale']}")
def job_rating_sale(t: Tables) -> DataFrame:
    return _rating(t, SOURCES["sale"])


@query(f"WITH {X.DIMENSION}, {_FACTS} {_SELECTS['organization']}")
def job_rating_organization(t: Tables) -> DataFrame:
    return _rating(t, SOURCES["organization"])


@query(f"WITH {X.DIMENSION}, {_FACTS} {_SELECTS['tranche']}")
def job_rating_tranche(t: Tables) -> DataFrame:
    return _rating(t, SOURCES["tranche"])


@query(f"WITH {X.DIMENSION}, {_FACTS} {_rating_select('TRANCHE', 'issuer_num', _OPEN_DEALS, 'CAST(deal_id AS BIGINT)')}")
def job_rating_tranche_open_deal(t: Tables) -> DataFrame:
    """The tranche's own form: the dimension counts only where an open deal was found."""
    return _rating(t, OWN_FORMS["tranche"])


@query(f"WITH {X.DIMENSION}, {_FACTS} {_SELECTS['maturity']}")
def job_rating_maturity(t: Tables) -> DataFrame:
    return _rating(t, SOURCES["maturity"])


@query(f"""WITH {X.DIMENSION}, {_FACTS}
SELECT *, DATE '2025-03-04' AS load_dt FROM ({' UNION ALL '.join('(' + s + ')' for s in _SELECTS.values())})""")
def job_rating_union(t: Tables) -> DataFrame:
    wide = lambda df: df.withColumn("ORG_ID", F.col("ORG_ID").cast("bigint"))
    return consolidate([wide(_rating(t, source)) for source in SOURCES.values()], AS_OF)


# ------------------------------------------------------------- invoices, fees


@query(_CHAIN_SQL + """
SELECT line_no, l_orderkey, l_partkey, l_suppkey, l_shipdate, CAST(line_sk AS BIGINT) AS line_sk,
       CAST(q.order_sk AS BIGINT) AS order_sk, DATE '2024-01-01' AS start_dt, DATE '2999-12-31' AS end_dt
FROM line_numbered LEFT JOIN (SELECT o_orderkey, DENSE_RANK() OVER (ORDER BY order_no) AS order_sk FROM ord WHERE o_orderpriority <> '5-LOW') q
  ON q.o_orderkey = l_orderkey""")
def job_scd2_chain(t: Tables) -> DataFrame:
    """Customer, order and line tables; quarantined orders stay out of the chain."""
    low = F.col("o_orderpriority") == "5-LOW"
    number = F.concat(F.lit("O"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    errors = t.orders.select(
        F.when(low, "orders").otherwise("none").alias("table_name"), F.to_json(F.struct(number.alias("order_no"))).alias("primary_keys")
    )
    return scd2_chain(CHAIN, chain_sources(t, False), dt.date(2024, 1, 1), errors=errors)["lineitem"]


def _fee_origin(t: Tables, flag: str) -> DataFrame:
    """Fee records of the lines with one return flag."""
    return t.lineitem.filter(F.col("l_returnflag") == flag).select(
        F.col("l_linestatus").alias("REGL_FEE_TYPE"),
        F.col("l_returnflag").alias("REGL_FEE_CLASS"),
        F.concat(F.lit("fee "), "l_linenumber").alias("FEE_DESC"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("EFFT_DT"),
        F.lit("SYS").alias("SRC_SYS_CD"),
        F.lit("2024-01-01 00:00:00").alias("LOAD_DTM"),
        F.col("l_partkey").alias("FEE_ID"),
        F.lit("PART").alias("FEE_ID_TYPE"),
    )


@query("""
WITH f AS (SELECT DISTINCT l_linestatus AS "REGL_FEE_TYPE", l_returnflag AS "REGL_FEE_CLASS", 'fee ' || l_linenumber AS "FEE_DESC",
  strftime(l_shipdate, '%Y-%m-%d') AS "EFFT_DT", 'SYS' AS "SRC_SYS_CD", '2024-01-01 00:00:00' AS "LOAD_DTM", l_partkey AS "FEE_ID",
  'PART' AS "FEE_ID_TYPE" FROM lineitem)
SELECT md5(CAST("FEE_ID" AS VARCHAR)) AS "FEE_HUB_HASH", "REGL_FEE_TYPE", "REGL_FEE_CLASS", "FEE_DESC", "EFFT_DT",
  md5(concat_ws(',', LENGTH("EFFT_DT") || ':' || "EFFT_DT", LENGTH("FEE_DESC") || ':' || "FEE_DESC",
      LENGTH(CAST("FEE_ID" AS VARCHAR)) || ':' || "FEE_ID", LENGTH("FEE_ID_TYPE") || ':' || "FEE_ID_TYPE",
      LENGTH("REGL_FEE_CLASS") || ':' || "REGL_FEE_CLASS", LENGTH("REGL_FEE_TYPE") || ':' || "REGL_FEE_TYPE")) AS "DIFF_HASH",
  "SRC_SYS_CD", "LOAD_DTM", "FEE_ID", "FEE_ID_TYPE" FROM f""")
def job_fee_satellite(t: Tables) -> DataFrame:
    return fees.fee_satellite([_fee_origin(t, flag) for flag in ("R", "A", "N")])


@query("""
WITH r AS (SELECT l_partkey AS invc_line_dtl_id, 'S' || l_linenumber AS regl_fee_schd_nm, l_returnflag AS regl_fee_prgm, l_linestatus FROM lineitem),
h AS (SELECT invc_line_dtl_id, regl_fee_schd_nm, regl_fee_prgm,
        md5(LENGTH(regl_fee_schd_nm) || ':' || regl_fee_schd_nm || ',' || LENGTH(regl_fee_prgm) || ':' || regl_fee_prgm) AS diff_hash,
        CASE WHEN l_linestatus = 'F' THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS load_dtm FROM r)
SELECT invc_line_dtl_id, regl_fee_schd_nm, regl_fee_prgm, diff_hash, MIN(load_dtm) AS load_dtm FROM h GROUP BY 1, 2, 3, 4""")
def job_fee_schedule(t: Tables) -> DataFrame:
    """Closed lines first, all lines a month later."""
    rows = t.lineitem.select(
        F.col("l_partkey").alias("invc_line_dtl_id"), F.concat(F.lit("S"), "l_linenumber").alias("regl_fee_schd_nm"),
        F.col("l_returnflag").alias("regl_fee_prgm"), "l_linestatus",
    )
    closed = rows.filter(F.col("l_linestatus") == "F")
    stored = fees.fee_schedule(closed, None, dt.datetime(2024, 1, 1))
    return fees.fee_schedule(rows, stored, dt.datetime(2024, 2, 1))


def _aggregate_origin(t: Tables, status: str) -> DataFrame:
    return t.lineitem.filter(F.col("l_linestatus") == status).select(
        F.col("l_orderkey").alias("invc_line_dtl_id"), "l_returnflag", F.col("l_partkey").alias("RATIFER_ID"),
        F.lit(dt.date(2024, 5, 1)).alias("load_dt"),
    )


@query(_CHAIN_SQL + """,
open_copies AS (
  SELECT o_orderkey, (SELECT MAX(order_sk) FROM ord_numbered) + DENSE_RANK() OVER (ORDER BY order_no) AS order_sk
  FROM ord_copies WHERE o_orderstatus <> 'P'),
again AS (
  SELECT line_no || '-N' AS line_no, -l_orderkey - 1 AS l_orderkey, l_partkey, l_suppkey, l_shipdate,
         (SELECT MAX(line_sk) FROM line_numbered) + DENSE_RANK() OVER (ORDER BY line_no || '-N') AS line_sk FROM one_line)
SELECT line_no, l_orderkey, l_partkey, l_suppkey, l_shipdate, CAST(line_sk AS BIGINT) AS line_sk, CAST(order_sk AS BIGINT) AS order_sk,
       DATE '2024-01-01' AS start_dt, DATE '2999-12-31' AS end_dt
FROM line_numbered LEFT JOIN (SELECT o_orderkey, order_sk FROM ord_numbered) ON o_orderkey = l_orderkey
UNION ALL SELECT line_no, l_orderkey, l_partkey, l_suppkey, l_shipdate, CAST(line_sk AS BIGINT), CAST(order_sk AS BIGINT),
       DATE '2024-02-01', DATE '2999-12-31' FROM again LEFT JOIN open_copies ON o_orderkey = l_orderkey""")
def job_scd2_chain_second_run(t: Tables) -> DataFrame:
    """Second run of all three levels: changed and new parents reach the lines, quarantined orders stay out."""
    first = scd2_chain(CHAIN, chain_sources(t, False), dt.date(2024, 1, 1))
    number = F.concat(F.lit("O"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lit("-N"))
    bad = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P")
    errors = t.orders.select(
        F.when(bad, "orders").otherwise("none").alias("table_name"), F.to_json(F.struct(number.alias("order_no"))).alias("primary_keys")
    )
    sources = chain_sources(t, True, new_lines=True)
    return scd2_chain(CHAIN, sources, dt.date(2024, 2, 1), targets=first, errors=errors, on_missing="keep")["lineitem"]


def _crosswalk(t: Tables) -> tuple[DataFrame, DataFrame]:
    # sizes up to ten match nothing
    number = F.when(F.col("p_size") > 10, F.col("p_partkey")).otherwise(-F.col("p_partkey") - 1)
    lookup = t.part.select(
        number.alias("ratifer_num"), F.concat(F.lit("id-"), "p_partkey").alias("rating_identifier")
    )
    return fees.rating_crosswalk([_aggregate_origin(t, s) for s in ("O", "F")], lookup)


@query("""
SELECT DISTINCT l_orderkey AS invc_line_dtl_id, l_partkey AS "RATFR_ID", CASE WHEN p_partkey IS NOT NULL THEN 'id-' || p_partkey END AS ratg_id,
       DATE '2024-05-01' AS load_dt FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) ON p_partkey = l_partkey""")
def job_rating_crosswalk(t: Tables) -> DataFrame:
    return _crosswalk(t)[1]


@query("SELECT DISTINCT l_orderkey AS invc_line_dtl_id, l_returnflag, DATE '2024-05-01' AS load_dt FROM lineitem")
def job_rating_aggregate(t: Tables) -> DataFrame:
    return _crosswalk(t)[0]


@query("""
SELECT CAST(date_part('year', o_orderdate) AS BIGINT) AS rpt_year, 'EUR' AS cury_from_nm, 'USD' AS cury_to_nm, o_totalprice AS avg_year_xcgh_rate,
       DATE '2024-05-01' AS load_dt FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT CAST(date_part('year', o_orderdate) AS BIGINT), 'EUR', 'GBP', o_totalprice, DATE '2024-05-01' FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT CAST(date_part('year', o_orderdate) AS BIGINT), 'GBP', 'USD', o_totalprice, DATE '2024-05-01' FROM orders WHERE o_orderstatus = 'P'""")
def job_exchange_rates(t: Tables) -> DataFrame:
    """Order values stand in for the published series; one state is one series."""
    series = lambda state: t.orders.filter(F.col("o_orderstatus") == state).select(
        F.year("o_orderdate").cast("string").alias("period"), F.col("o_totalprice").cast("string").alias("value"),
        F.col("o_orderdate").alias("date"),
    )
    return fees.exchange_rates({"USD": series("O"), "GBP": series("F")}, series("P"), dt.date(2024, 5, 1))
