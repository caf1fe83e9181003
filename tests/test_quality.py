"""Rules, suggestions, comparison, lineage, catalogue and domain jobs."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import catalog, lineage
from millrace.operators import columns as C
from millrace.operators import quality as Q
from millrace.operators.joins import left_join
from millrace.plans import fees
from millrace.plans.chains import Level, scd2_chain

AT = dt.datetime(2024, 1, 1)


def test_parse_rule():
    assert Q.parse_rule("isComplete()", "c") == Q.Rule("isComplete", "c")
    assert Q.parse_rule('.isContainedIn("c", ["a"], 0.5)', "c").arguments == (["a"], 0.5)
    assert Q.parse_rule("hasMin(-1)", "c").text == '.hasMin("c", -1)'
    for bad in ("__import__('os')", "isComplete(open('x'))", "noRule()", "1 + 1", "satisfies('c > 0')"):
        with pytest.raises(ValueError):
            Q.parse_rule(bad, "c")


def test_rules_on_nulls_and_empty_input(spark):
    rules = [Q.parse_rule(t, "v") for t in ("isComplete()", "isUnique()", "isNonNegative()", "hasMax(3)", "hasPattern('^1')")]
    df = spark.createDataFrame([(1,), (1,), (None,), (-2,)], "v int")
    got = {r["constraint"]: (r["constraint_status"], r["constraint_message"]) for r in Q.verify(df, rules).collect()}
    assert got["isComplete(v)"] == ("Failure", "Value: 0.750000")
    assert got["isUnique(v)"] == ("Failure", "Value: 0.333333")
    assert got["isNonNegative(v)"] == ("Failure", "Value: -2.000000")
    assert got["hasMax(v)"] == ("Success", "")
    assert got["hasPattern(v)"] == ("Failure", "Value: 0.666667")
    empty = Q.verify(df.filter("false"), rules).collect()
    assert {r["constraint_status"] for r in empty} == {"Success"} and len(empty) == 5


def test_one_bad_row_in_five_million_fails(spark):
    n = F.col("id")
    df = spark.range(5_000_000).select(
        F.when(n != 7, n).alias("v"), F.when(n != 7, "a").otherwise("z").alias("s"), F.when(n == 7, 8).otherwise(n).alias("u"),
    )
    bad = [("isComplete()", "v"), ("hasCompleteness(1.0)", "v"), ("isUnique()", "u"), ("isContainedIn(['a'])", "s"), ("hasPattern('^a')", "s"), ("satisfies('s = \"a\"')", "s")]
    good = [("hasCompleteness(0.9999998)", "v"), ("isUnique()", "v"), ("isContainedIn(['a'], 0.9999998)", "s")]
    found = Q.verify(df, [Q.parse_rule(t, c, allow_sql=True) for t, c in bad + good]).collect()
    status = {r["dq_rule"]: r["constraint_status"] for r in found}
    assert [status[Q.parse_rule(t, c, allow_sql=True).text] for t, c in bad + good] == ["Failure"] * 6 + ["Success"] * 3


def test_bounds_compare_in_the_columns_type(spark):
    df = spark.sql("SELECT 10000000000000L AS big, -1e-9D AS tiny, DATE '2024-01-05' AS day, 'x' AS word, CAST(NULL AS INT) AS none")
    rules = [("hasMin(10000000000000)", "big"), ("hasMax(9999999999999)", "big"), ("isNonNegative()", "tiny"), ("hasMin('2024-01-06')", "day"), ("hasMax('2024-01-06')", "day"), ("hasMin(1)", "none"), ("isPositive()", "word")]
    found = {r["dq_rule"]: r["constraint_status"] for r in Q.verify(df, [Q.parse_rule(*r) for r in rules]).collect()}
    assert [found[Q.parse_rule(*r).text] for r in rules] == ["Success", "Failure", "Failure", "Failure", "Success", "Success", "Success"]
    with pytest.raises(ValueError):
        Q.verify(df, [Q.Rule("isNonNegative", "day")])


def test_suggest(spark):
    data = [(i, -i, str(i), "a" if i % 2 else None, "x" if i < 95 else "y") for i in range(100)]
    df = spark.createDataFrame(data, "id int, neg int, num string, half string, cat string")
    found = {(r["source_col_name"], r["rule"]): r["dq_rule"] for r in Q.suggest(df).collect()}
    assert found[("id", "isComplete")] == '.isComplete("id")' and ("id", "isUnique") in found and ("id", "isNonNegative") in found
    assert ("neg", "isNonNegative") not in found
    assert found[("num", "hasDataType")] == ".hasDataType(\"num\", 'bigint')"
    assert found[("half", "hasCompleteness")].startswith('.hasCompleteness("half", 0.4')
    assert not [k for k in found if k[1] == "isContainedIn"]
    ranged = {(r["source_col_name"], r["rule"]): r["dq_rule"] for r in Q.suggest(df, list_values=2).collect()}
    assert ranged[("cat", "isContainedIn")] == ".isContainedIn(\"cat\", ['x', 'y'])"
    for (column, _), text in {**found, **ranged}.items():
        assert Q.parse_rule(text, column).column == column


def test_cell_diff_is_null_safe_and_refuses_conflicting_keys(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 5), (3, "z", 1)], "id int, name string, age int")
    b = spark.createDataFrame([(1, "x", 7), (2, "y", 5), (4, "q", 1)], "id int, name string, age int")
    assert rows(Q.cell_diff(a, b, "id"), "id", "column_names") == [(1, ["age"])]
    assert rows(Q.missing_keys(a, b, "id")) == [(3, "target"), (4, "source")]
    with pytest.raises(PySparkException):
        Q.cell_diff(a.unionByName(b), b, "id").collect()


def test_cell_diff_sample(spark):
    a = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    b = a.withColumn("v", F.lit(2))
    assert Q.cell_diff(a, b, "k", sample=50).count() == 50
    assert rows(Q.cell_diff(a, b, "k", sample=50, seed=1)) == rows(Q.cell_diff(a, b, "k", sample=50, seed=1))


# --------------------------------------------------------------------- lineage


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "target string, source string")


def test_roots_in_a_diamond(spark):
    e = edges(spark, [("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("c", "x")])
    assert rows(lineage.root_sources(e, "d")) == [("d", "a"), ("d", "x")]
    assert rows(lineage.root_sources(e)) == [("b", "a"), ("c", "a"), ("c", "x"), ("d", "a"), ("d", "x")]


def test_roots_end_on_cycles(spark):
    e = edges(spark, [("a", "b"), ("b", "a"), ("b", "r"), ("s", "s"), ("s", "a")])
    assert rows(lineage.root_sources(e)) == [("a", "r"), ("b", "r"), ("s", "r")]
    assert rows(lineage.root_sources(edges(spark, [("a", "b"), ("b", "a")]))) == []


def test_roots_of_a_long_chain(spark):
    chain = edges(spark, [(str(i), str(i + 1)) for i in range(6)])
    assert rows(lineage.root_sources(chain, "0")) == [("0", "6")]
    assert rows(lineage.root_sources(chain)) == [(str(i), "6") for i in range(6)]


def test_log_records_steps(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, 2)], "k int, w int")
    log = lineage.LineageLog("job", "finance")
    j = log.apply(left_join, {"a": a, "b": b}, "ab", AT, "k", details={"key_cols": ["k"]})
    c = log.apply(C.cut_out, {"ab": j}, "slim", AT, ["v"])
    s = log.sql(spark, "SELECT k, w + 1 AS w FROM {slim}", {"slim": c}, "out", AT)
    log.finish(s, "out", "/data/out", AT, ["slim"])
    got = {r["transformation_func_nm"]: r for r in log.to_frame(spark).collect()}
    assert got["left_join"]["source_tables"] == ["a", "b"] and got["left_join"]["right_df_id"] == "b"
    assert got["cut_out"]["dropped_cols"] == ["v"] and got["Final"]["final_path"] == "/data/out"
    assert rows(s) == [(1, 3)]
    assert rows(lineage.root_sources(lineage.edges_of(log.to_frame(spark)), "out")) == [("out", "a"), ("out", "b")]
    with pytest.raises(ValueError):
        log.record("x", "y", AT, nonsense=1)


# ------------------------------------------------------------------- catalogue


def test_processed_feed_from_recorded_events(spark):
    df = spark.createDataFrame([(1, 2.5, AT)], "Id int, price double, at timestamp_ntz").withColumn("d", F.lit(1).cast("decimal(9,2)"))
    log = lineage.LineageLog("job", "esg")
    log.finish(df, "Final_T", "/data/t", AT)
    feed = catalog.processed_feed(log.to_frame(spark), labels={"esg": "Climate"})
    assert feed.columns == list(catalog.FEED_COLUMNS)
    got = rows(feed.filter("`Asset Type` = 'Column'"), "Name", "Data Type", "Community")
    assert got == [("at", "timestamp_ntz", "Climate"), ("d", "Decimal Number", "Climate"),
                   ("id", "Whole Number", "Climate"), ("price", "double", "Climate")]


def test_column_manifest(spark):
    df = spark.createDataFrame([], "a int, b string")
    found = json.loads(catalog.column_manifest(df).first()[0])
    assert found == {"ColumnList": [{"Column_Name": "a", "Type": "int"}, {"Column_Name": "b", "Type": "string"}]}


def test_latest_versions_and_choice(spark):
    inv = spark.createDataFrame([("p", 1, "true"), ("p", 2, ""), ("p", 3, "false"), ("q", 1, None), ("r", 1, "false")],
                                "pipeline_id string, version_number int, active string")
    assert rows(catalog.latest_versions(inv)) == [("p", 2), ("q", 1)]
    wanted = spark.createDataFrame([("p", None), ("q", 2), ("r", None), ("zz", None)], "pipeline_id string, version_number int")
    assert rows(catalog.choose_pipelines(inv, wanted)) == [("p", 2, True), ("q", None, False), ("r", None, False), ("zz", None, False)]


def test_inventory_files(spark, tmp_path):
    inv = spark.createDataFrame([("p", "1", "app", ["x"])], "pipeline_id string, version_number string, app_name string, tags array<string>")
    cols = spark.createDataFrame([("p", "1", 2, "b"), ("p", "1", 1, "a")], "pipeline_id string, version_number string, sequence_number int, source_column_name string")
    packed = catalog.pack_inventory(inv, cols, ["sequence_number", "source_column_name"], page_rows=10)
    row = packed.first()
    assert json.loads(row["pipeline_columns"])[0] == {"sequence_number": 1, "source_column_name": "a"} and row["tags"] == '["x"]'
    catalog.write_inventory(packed, str(tmp_path / "inv"))
    assert spark.read.json(str(tmp_path / "inv")).first()["app_name"] == "app"


# ------------------------------------------------------------------------ jobs


def test_chain_gives_children_their_parent(spark):
    levels = [Level("hdr", "hk", "hid"), Level("line", "lk", "lid", on=[("bill", "bill")])]
    src = lambda v: {
        "hdr": spark.createDataFrame([("h1", 1, v), ("h2", 2, "s")], "hk string, bill int, t string"),
        "line": spark.createDataFrame([("l1", 1, "a"), ("l2", 2, v), ("l3", 9, "c")], "lk string, bill int, t string"),
    }
    one = scd2_chain(levels, src("x"), dt.date(2024, 1, 1))
    assert rows(one["line"], "lk", "hid", "lid") == [("l1", 1, 1), ("l2", 2, 2), ("l3", None, 3)]
    two = scd2_chain(levels, src("y"), dt.date(2024, 2, 1), targets=one)
    assert rows(two["hdr"].filter("hk = 'h1'"), "t", "hid") == [("x", 1), ("y", 1)]
    assert two["line"].count() == 4 and rows(two["line"].filter("lk = 'l2'"), "hid", "lid") == [(2, 2), (2, 2)]
    same = scd2_chain(levels, src("y"), dt.date(2024, 3, 1), targets=two)
    assert rows(same["line"]) == rows(two["line"])


def test_exchange_rates_drop_headings(spark):
    euro = spark.createDataFrame([("Source:", "x"), ("2022", "1.05"), ("2021", "n/a")], "period string, value string")
    pound = spark.createDataFrame([("2020-12-31", "1.3")], "date string, value string")
    out = fees.exchange_rates({"USD": euro}, pound, dt.date(2024, 1, 1))
    assert rows(out, "rpt_year", "cury_from_nm", "cury_to_nm", "avg_year_xcgh_rate") == [
        (2020, "GBP", "USD", 1.3), (2021, "EUR", "USD", None), (2022, "EUR", "USD", 1.05),
    ]


def test_fee_schedule_keeps_the_first_load(spark):
    df = spark.createDataFrame([(1, "a", "b"), (1, "a", "b")], "invc_line_dtl_id int, regl_fee_schd_nm string, regl_fee_prgm string")
    one = fees.fee_schedule(df, None, dt.datetime(2024, 1, 1))
    two = fees.fee_schedule(df.unionByName(df.withColumn("regl_fee_prgm", F.lit("c"))), one, dt.datetime(2024, 2, 1))
    assert rows(two, "regl_fee_prgm", "load_dtm") == [("b", "2024-01-01 00:00:00"), ("c", "2024-02-01 00:00:00")]


def test_review_suggests_only_without_rules(spark):
    df = spark.createDataFrame([(1,)], "v int")
    assert Q.review(df, [Q.Rule("isComplete", "v")])[1] is None
    assert Q.review(df, [])[0] is None and Q.review(df, [])[1].count() > 0


def test_records_of_a_run(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "v int")
    out = Q.with_run(Q.verify(df, [Q.Rule("isComplete", "v")]), "p", AT)
    assert rows(out, "execution_id", "pipeline_id", "constraint_status") == [("p_20240101000000000000", "p", "Success")]
    log = lineage.LineageLog("job", "esg")
    log.finish(df, "t", "/t", AT)
    for _ in range(2):
        log.save(spark, str(tmp_path / "events"))
    assert spark.read.schema(lineage.EVENT_SCHEMA).parquet(str(tmp_path / "events")).count() == 2
