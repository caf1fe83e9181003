"""Join, window and set queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import joins as J
from millrace.operators import sets as S
from millrace.operators import windows as W
from millrace.queries import fixtures as X
from millrace.queries.registry import Tables, query
from millrace.scratch import work_dir
from millrace.sources.targets import read_latest_partition

# rows of a key from which the joins treat it as hot; keys of the test tables reach it
HOT_ROWS = 12


def moved(key: str, when: Column, shift: int = 1) -> Column:
    """The key, or one that matches nothing: unmatched rows that are read like all others."""
    return F.when(when, -F.col(key) - shift).otherwise(F.col(key))



@query("""
SELECT o.*, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def jn_inner_diff_keys(t: Tables) -> DataFrame:
    return J.join(t.orders, t.customer, left_keys="o_custkey", right_keys="c_custkey")


@query("""
SELECT l.l_orderkey AS orderkey, l.l_linenumber, l.l_quantity, o.o_custkey, o.o_orderstatus
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def jn_inner(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_custkey", "o_orderstatus")
    return J.inner_join(lines, orders, "orderkey")


@query("""
SELECT c.c_custkey AS custkey, c.c_name, o.o_orderkey FROM customer c
LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o ON o.o_custkey = c.c_custkey""")
def jn_left(t: Tables) -> DataFrame:
    urgent = t.orders.select(moved("o_custkey", F.col("o_orderpriority") != "1-URGENT").alias("custkey"), "o_orderkey")
    return J.left_join(t.customer.select(F.col("c_custkey").alias("custkey"), "c_name"), urgent, "custkey", hot_rows=HOT_ROWS)


@query("""
WITH a AS (SELECT CASE WHEN l_returnflag = 'R' THEN l_partkey ELSE -l_partkey - 1 END AS partkey, l_orderkey, l_linenumber FROM lineitem),
     b AS (SELECT CASE WHEN p_type <> 'PROMO' THEN p_partkey ELSE -p_partkey - 1000000000 END AS partkey, p_name FROM part)
SELECT COALESCE(a.partkey, b.partkey) AS partkey, a.l_orderkey, a.l_linenumber, b.p_name FROM a FULL OUTER JOIN b ON a.partkey = b.partkey""")
def jn_full_outer(t: Tables) -> DataFrame:
    lines = t.lineitem.select(moved("l_partkey", F.col("l_returnflag") != "R").alias("partkey"), "l_orderkey", "l_linenumber")
    parts = t.part.select(moved("p_partkey", F.col("p_type") == "PROMO", 1_000_000_000).alias("partkey"), "p_name")
    return J.outer_join(lines, parts, "partkey", hot_rows=HOT_ROWS)


@query("""
WITH one AS (
  SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderdate,
                        ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1)
SELECT c_custkey, c_name, o_orderkey, o_orderdate FROM customer LEFT JOIN one ON o_custkey = c_custkey""")
def jn_lookup_first(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    customers = t.customer.select("c_custkey", "c_name")
    return J.lookup_join(customers, orders, left_keys="c_custkey", right_keys="o_custkey", order_by=["o_orderdate", "o_orderkey"])


@query("""
SELECT l.* FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber)""")
def jn_anti(t: Tables) -> DataFrame:
    returned = t.lineitem.filter(F.col("l_returnflag") == "R")
    return J.anti_join(t.lineitem, returned, ["l_orderkey", "l_linenumber"])


@query("""
SELECT s_suppkey, s_name, s_nationkey, n_nationkey, n_name, n_regionkey FROM supplier
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON n_nationkey = s_nationkey""")
def jn_left_diff_keys(t: Tables) -> DataFrame:
    nations = t.nation.withColumn("n_nationkey", moved("n_nationkey", F.col("n_regionkey") == 2))
    return J.left_join_on(t.supplier.drop("s_acctbal"), nations, "s_nationkey", "n_nationkey")


@query("""
WITH dim AS (SELECT c_name, c_mktsegment, CAST(DENSE_RANK() OVER (ORDER BY c_name) AS BIGINT) AS sk FROM customer)
SELECT o.o_orderkey, d.sk AS customer_fk FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN dim d ON d.c_name = c.c_name AND d.c_mktsegment = c.c_mktsegment AND d.c_mktsegment <> 'BUILDING'""")
def jn_surrogate_lookup(t: Tables) -> DataFrame:
    dim = W.assign_sequence(t.customer.select("c_name", "c_mktsegment"), "c_name", "sk")
    building = F.col("c_mktsegment") == "BUILDING"
    dim = dim.withColumn("c_name", F.when(building, F.concat(F.lit("not "), "c_name")).otherwise(F.col("c_name")))
    facts = J.join(t.orders.select("o_orderkey", "o_custkey"), t.customer, left_keys="o_custkey", right_keys="c_custkey")
    facts = facts.select("o_orderkey", F.col("c_name").alias("customer"), F.col("c_mktsegment").alias("segment"))
    return J.surrogate_lookup(facts, dim, ["c_name", "c_mktsegment"], "sk", "customer_fk", ["customer", "segment"])


def quarantine(t: Tables) -> DataFrame:
    """Stored error records of every order; the newest day's carry the keys of high priority."""
    high = F.col("o_orderpriority") == "2-HIGH"
    records = t.orders.select(
        F.when(high, "orders").otherwise("customer").alias("table_name"),
        F.when(high, F.to_json(F.struct("o_orderkey"))).otherwise(F.to_json(F.struct("o_custkey"))).alias("primary_keys"),
        F.lit("2024-05-02").alias("run_dt"),
    )
    older = t.orders.select(
        F.lit("orders").alias("table_name"), F.to_json(F.struct("o_orderkey")).alias("primary_keys"), F.lit("2024-04-30").alias("run_dt")
    )
    path = work_dir(t.spark, "errors")
    records.unionByName(older).write.partitionBy("run_dt").parquet(path)
    return read_latest_partition(t.spark, path, "run_dt")


@query("SELECT * FROM orders WHERE o_orderpriority <> '2-HIGH'")
def jn_quarantine(t: Tables) -> DataFrame:
    return J.exclude_quarantined(t.orders, quarantine(t), "orders", "o_orderkey")


@query("""
SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, c_nationkey AS parent_id FROM orders
LEFT JOIN customer ON c_custkey = o_custkey AND c_mktsegment <> 'BUILDING'""")
def jn_parent_id(t: Tables) -> DataFrame:
    child = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.lit(None).cast("int").alias("parent_id"))
    key = moved("c_custkey", F.col("c_mktsegment") == "BUILDING").alias("c_custkey")
    parent = t.customer.select(key, F.col("c_nationkey").alias("parent_id"))
    return J.propagate_parent_id(child, parent, [("o_custkey", "c_custkey")], "parent_id")


@query(f"""{X.WITH_CHANGES}
SELECT c.o_orderkey, c.o_totalprice FROM changes c JOIN target t ON t.o_orderkey = c.o_orderkey AND t.o_totalprice <> c.o_totalprice""")
def jn_semi_changed(t: Tables) -> DataFrame:
    columns = ["o_orderkey", "o_totalprice"]
    return J.semi_changed(X.order_changes(t).select(*columns), X.order_target(t).select(*columns), "o_orderkey", "o_totalprice")


@query(f"""WITH {X.DIMENSION}
SELECT o_orderkey, o_custkey, issuer_num FROM orders LEFT JOIN dimension
  ON entity_id = o_custkey AND CAST(end_dtm AS DATE) = DATE '9999-12-31'
 AND TIMESTAMP '2002-01-01 00:00:00' > efft_dtm
 AND TIMESTAMP '2002-01-01 00:00:00' <= COALESCE(term_dtm, TIMESTAMP '9999-12-31 23:59:59.999')""")
def jn_effective_dated(t: Tables) -> DataFrame:
    return J.effective_join(
        t.orders.select("o_orderkey", "o_custkey"), X.dated_customers(t), "o_custkey", "entity_id", dt.datetime(2002, 5, 17),
        "efft_dtm", "term_dtm", "end_dtm", take=["issuer_num"],
    )


@query("""
SELECT DISTINCT l.l_orderkey, l.l_partkey, p.p_name FROM lineitem l
LEFT JOIN (SELECT DISTINCT p_partkey, p_name FROM part WHERE p_size > 10) p ON p.p_partkey = l.l_partkey""")
def jn_crosswalk(t: Tables) -> DataFrame:
    lookup = t.part.withColumn("p_partkey", moved("p_partkey", F.col("p_size") <= 10))
    return J.crosswalk(t.lineitem.select("l_orderkey", "l_partkey"), lookup, "l_partkey", "p_partkey", "p_name")


# --------------------------------------------------------------------- windows

_LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(f"""
SELECT * EXCLUDE (n) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS n FROM lineitem) WHERE n = 1""")
def win_group_first(t: Tables) -> DataFrame:
    return W.first_per_group(t.lineitem, "l_orderkey", _LINE_ORDER.split(", "))


@query("SELECT event_id, user_id, event_type, CAST(DENSE_RANK() OVER (ORDER BY user_id, event_type) + 1000 AS BIGINT) AS seq FROM events")
def win_sequence(t: Tables) -> DataFrame:
    return W.assign_sequence(t.events.select("event_id", "user_id", "event_type"), ["user_id", "event_type"], "seq", start=1000)


@query("SELECT event_id, user_id, event_type, ts, MIN(ts) OVER (PARTITION BY user_id, event_type) AS first_ts FROM events")
def win_min_over(t: Tables) -> DataFrame:
    return W.min_over(t.events.select("event_id", "user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "first_ts")


# ------------------------------------------------------------------ sort, sets


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem ORDER BY l_shipdate DESC, l_orderkey DESC")
def ord_sort(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return S.sort_rows(rows, ["l_shipdate", "l_orderkey"], descending=True)


@query("""
SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem)
ORDER BY md5('7,' || LENGTH(CAST(l_orderkey AS VARCHAR)) || ':' || l_orderkey), l_orderkey LIMIT 1000""")
def ord_sample_keys(t: Tables) -> DataFrame:
    return S.sample_keys(t.lineitem, "l_orderkey", 1000, seed=7)


# lines returned or accepted, those without either on both sides: every line is read
_PARTS = "SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem WHERE l_returnflag IN ('{0}', 'N')"


def _pairs(t: Tables, flag: str) -> DataFrame:
    return t.lineitem.filter(F.col("l_returnflag").isin(flag, "N")).select(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))


@query(f"{_PARTS.format('R')} EXCEPT {_PARTS.format('A')}")
def set_complement(t: Tables) -> DataFrame:
    return S.complement(_pairs(t, "R"), _pairs(t, "A").select("s", "p"))


@query("SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def set_union_all(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return S.union_all(customers, t.supplier.select("s_suppkey", "s_name"))


@query("SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def set_union_by_name(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return S.union_by_name(customers, t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("k")))


@query("""
SELECT *, DATE '2024-06-01' AS load_dt FROM (
  SELECT c_custkey AS k, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier
  UNION ALL SELECT p_partkey, 'part' FROM part UNION ALL SELECT o_orderkey, 'order' FROM orders)""")
def set_union_many(t: Tables) -> DataFrame:
    sources = [("customer", t.customer, "c_custkey"), ("supplier", t.supplier, "s_suppkey"), ("part", t.part, "p_partkey"),
               ("order", t.orders, "o_orderkey")]
    frames = [df.select(F.col(key).alias("k"), F.lit(kind).alias("kind")) for kind, df, key in sources]
    return S.union_many(frames, F.lit(dt.date(2024, 6, 1)))


@query(f"{_PARTS.format('R')} INTERSECT {_PARTS.format('A')}")
def set_intersect(t: Tables) -> DataFrame:
    return S.common_rows(_pairs(t, "R"), _pairs(t, "A"))


@query("""
WITH b AS (SELECT l_partkey AS p, CAST(SUM(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN -1 ELSE 0 END) AS BIGINT) AS n
           FROM lineitem GROUP BY 1)
SELECT CASE WHEN n > 0 THEN 'source' ELSE 'target' END AS only_in, ABS(n) AS copies, p FROM b WHERE n <> 0""")
def set_two_way_minus(t: Tables) -> DataFrame:
    return S.two_way_minus(_pairs(t, "R").select("p"), _pairs(t, "A").select("p"))


@query(f"""{X.WITH_CHANGES},
a AS (SELECT * FROM target), b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM changes),
l AS (SELECT COUNT(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)),
r AS (SELECT COUNT(*) AS n FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))
SELECT (l.n = 0 AND r.n = 0) AS is_equal, CAST(l.n AS BIGINT) AS only_left, CAST(r.n AS BIGINT) AS only_right FROM l, r""")
def set_frames_equal(t: Tables) -> DataFrame:
    return S.frames_equal(X.order_target(t), X.order_changes(t).drop("op"))
