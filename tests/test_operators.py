"""Edge cases of the column, join, aggregate, window and set operators."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions.hashing import row_hash
from millrace.functions.types import target_type
from millrace.operators import aggregates as A
from millrace.operators import columns as C
from millrace.operators import filters as L
from millrace.operators import joins as J
from millrace.operators import runlog
from millrace.operators import sets as S
from millrace.operators import windows as W


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# --------------------------------------------------------------------- columns


def test_add_column_list_cuts_rows_past_the_values(spark):
    df = frame(spark, [(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    assert rows(C.add_column(df, "n", [10, 20], "int", "k")) == [(1, "a", 10), (2, "b", 20)]


def test_add_column_longer_list_keeps_all_rows(spark):
    df = frame(spark, [(1,), (2,)], "k int")
    assert rows(C.add_column(df, "n", ["x", "y", "z"], "string", "k")) == [(1, "x"), (2, "y")]


def test_add_column_needs_an_order(spark):
    with pytest.raises(ValueError):
        C.add_column(frame(spark, [(1,)], "k int"), "n", [1], "int")


def test_add_computed_python_function_gives_text(spark):
    df = C.add_computed(frame(spark, [(1, 2)], "a int, b int"), "s", lambda a, b: str(a + b), "a", "b")
    assert df.dtypes[-1] == ("s", "string") and rows(df) == [(1, 2, "3")]


def test_drop_null_columns(spark):
    df = frame(spark, [(1, None, None), (2, "x", None)], "a int, b string, c string")
    assert C.drop_null_columns(df, "any").columns == ["a"]
    assert C.drop_null_columns(df, "all").columns == ["a", "b"]


def test_drop_null_columns_of_an_empty_frame(spark):
    df = frame(spark, [], "a int, b string")
    assert C.drop_null_columns(df, "any").columns == ["a", "b"]
    assert C.drop_null_columns(df, "all").columns == []


def test_convert_when_keeps_rows_with_a_null_condition(spark):
    df = frame(spark, [("a", 1), ("b", None), ("b", None), ("c", 0)], "v string, n int")
    assert rows(C.convert_when(df, "v", F.upper, "n = 1")) == [("A", 1), ("b", None), ("b", None), ("c", 0)]
    assert rows(C.convert_when(df, "v", F.upper, "n = 1", dedupe_unchanged=True)) == [("A", 1), ("b", None), ("c", 0)]


def test_convert_rejects_unknown_columns(spark):
    with pytest.raises(ValueError):
        C.convert(frame(spark, [(1,)], "a int"), ["zz"], F.upper)


def test_casts_give_null_for_bad_text(spark):
    df = frame(spark, [("1.5",), ("x",), (None,)], "v string")
    assert rows(C.to_float(df, "v")) == [(1.5,), (None,), (None,)]
    assert rows(C.to_int(frame(spark, [("7",), ("x",)], "v string"), "v")) == [(7,), (None,)]


def test_first_value_skips_sentinels_and_nan(spark):
    df = frame(spark, [("NR", float("nan"), 3.0), ("", 2.0, 1.0), ("Aa1", 1.0, 1.0), (None, None, None)], "a string, b double, c double")
    out = C.first_value(df.select("a", F.col("b").cast("string").alias("b"), F.col("c").cast("string").alias("c")), "r", "a", "b", "c")
    assert rows(out, "r") == [("2.0",), ("3.0",), ("Aa1",), (None,)]


def test_first_value_of_numbers(spark):
    df = frame(spark, [(float("nan"), 3.0), (2.0, 1.0)], "b double, c double")
    assert rows(C.first_value(df, "r", "b", "c"), "r") == [(2.0,), (3.0,)]


def test_typed_select_types_lengths_and_bad_values(spark):
    df = frame(spark, [("1", "12.345", "2024-02-30", "abcdef", "INS"), ("x", "7", "2024-02-01", "z", "DEL")],
               "a string, b string, c string, d string, op string")
    columns = [
        {"sequence_number": "4", "source_column_name": "d", "target_column_name": "D", "target_datatype": "varchar", "target_length": "3"},
        {"sequence_number": "1", "source_column_name": "a", "target_column_name": "A", "target_datatype": "int"},
        {"sequence_number": "2", "source_column_name": "b", "target_column_name": "B", "target_datatype": "decimal", "target_length": "9", "target_precision": "2"},
        {"sequence_number": "3", "source_column_name": "c", "target_column_name": "C", "target_datatype": "datetime"},
    ]
    out = C.typed_select(df, columns, keep=["op", "absent"])
    assert out.columns == ["A", "B", "C", "D", "op"]
    assert [t for _, t in out.dtypes] == ["int", "decimal(9,2)", "timestamp", "string", "string"]
    got = rows(out.select("A", F.col("B").cast("string"), F.col("C").cast("date"), "D"))
    assert got == [(1, "12.35", None, "abcdef"), (None, "7.00", dt.date(2024, 2, 1), "z")]
    assert rows(C.typed_select(df, columns, truncate=True), "D") == [("abc",), ("z",)]


def test_target_type():
    assert target_type("DATETIME") == "timestamp"
    assert target_type("decimal", "10", "2") == "decimal(10,2)"
    assert target_type("Varchar", "10") == "string"


def test_evolve_adds_typed_nulls_and_drops_columns(spark):
    stored = frame(spark, [(1, "x", "old")], "k int, v string, gone string")
    source = frame(spark, [], "k bigint, fresh double, v string")
    out = C.evolve_to(stored, source.schema)
    assert out.dtypes == [("k", "bigint"), ("fresh", "double"), ("v", "string")] and rows(out) == [(1, None, "x")]


def test_full_row_key_keeps_null_places(spark):
    df = frame(spark, [("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert rows(C.full_row_key(df), "FullKey") == [("a|b|",), ("a||b",)]


def test_typed_select_formats_unreadable_dates_as_null(spark):
    df = frame(spark, [("2024-01-02",), ("oops",), (None,)], "d string")
    record = [{"sequence_number": "1", "source_column_name": "d", "target_column_name": "day", "target_datatype": "string", "target_datetime_format": "dd.MM.yyyy"}]
    assert rows(C.typed_select(df, record)) == [("02.01.2024",), (None,), (None,)]


def test_quarantine_refuses_unreadable_keys(spark):
    df = frame(spark, [(1, "a"), (2, "b")], "id bigint, v string")
    errors = frame(spark, [("t", '{"id": 2}'), ("t", None), ("other", "{")], "table_name string, primary_keys string")
    assert rows(J.exclude_quarantined(df, errors, "t", "id")) == [(1, "a")]
    for text in ("{", '{"id": "x"}', '{"key": 2}'):
        bad = frame(spark, [("t", text)], "table_name string, primary_keys string")
        with pytest.raises(PySparkException):
            J.exclude_quarantined(df, bad, "t", "id").collect()


def test_to_dict_is_last_wins_and_limited(spark):
    df = frame(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, n int")
    assert C.to_dict(df, "k", "v", "n", limit=10) == {1: "b", 2: "c"}
    with pytest.raises(ValueError):
        C.to_dict(df, "k", "v", "n", limit=1)


def test_select_environment_ignores_case_and_takes_the_last(spark):
    text = '[{"environment_name":"Dev","target_bucket_name":"a"},{"environment_name":"DEV","target_bucket_name":"b"}]'
    df = frame(spark, [(text,), ("[]",), (None,)], "envs string")
    assert rows(C.select_environment(df, "envs", "dev", prefix="s3://"), "location") == [("s3://b/data/final",), (None,), (None,)]


def test_type_labels_use_the_base_type(spark):
    names = ["bigint", "smallint", "decimal(10,2)", "Timestamp", "datetime", "varchar(20)", "struct<a:int>"]
    out = C.label_types(frame(spark, [(n,) for n in names], "t string"), "t")
    assert [r[0] for r in out.collect()] == [
        "Whole Number", "Whole Number", "Decimal Number", "Date Time", "Date Time", "Text", "struct<a:int>",
    ]


def test_row_hash_tells_apart_what_a_plain_join_does_not(spark):
    df = frame(spark, [("ab", "c"), ("a", "bc"), ("a", None), (None, "a"), ("a", ""), ("1:a", "-")], "x string, y string")
    safe = df.select(row_hash(["x", "y"])).distinct().count()
    legacy = df.select(row_hash(["x", "y"], legacy=True)).distinct().count()
    assert safe == 6 and legacy < 6


# --------------------------------------------------------------------- filters


def test_incremental_filter_is_inclusive_and_starts_at_1900(spark):
    df = frame(spark, [(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00"), (3, "2024-01-02 00:00:01")], "k int, t string")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    until = dt.datetime(2024, 1, 2)
    assert rows(L.incremental_filter(df, "t", dt.datetime(2024, 1, 1), until), "k") == [(1,), (2,)]
    assert rows(L.incremental_filter(df, "t", None, until), "k") == [(1,), (2,)]


def test_incremental_predicate_per_dialect():
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3, 4, 5)
    assert L.incremental_predicate(["x", "y"], a, b) == (
        "(x >= '2024-01-01 00:00:00' AND x <= '2024-01-02 03:04:05') OR (y >= '2024-01-01 00:00:00' AND y <= '2024-01-02 03:04:05')"
    )
    assert L.incremental_predicate(["x"], None, b, "oracle") == (
        "(x >= TIMESTAMP '1900-01-01 00:00:00' AND x <= TIMESTAMP '2024-01-02 03:04:05')"
    )
    zoned = L.incremental_predicate(["x"], a, b, "postgres", "Europe/Paris")
    assert zoned.startswith("((x AT TIME ZONE 'Europe/Paris') >= TIMESTAMP '2024-01-01 00:00:00' AND")
    with pytest.raises(ValueError):
        L.incremental_predicate(["x"], a, b, "sybase", "Europe/Paris")


def test_delete_by_key_keeps_null_keys(spark):
    df = frame(spark, [(1,), (2,), (None,)], "k int")
    assert rows(L.delete_by_key(df, "k", [2, None])) == [(1,), (None,)]
    assert rows(L.delete_by_key(df, "k", [])) == [(1,), (2,), (None,)]


# ----------------------------------------------------------------------- joins


def test_join_renames_colliding_columns(spark):
    left, right = frame(spark, [(1, "l")], "k int, v string"), frame(spark, [(1, "r")], "k int, v string")
    out = J.left_join(left, right, "k")
    assert out.columns == ["k", "v", "v_right"] and rows(out) == [(1, "l", "r")]


def test_left_join_on_keeps_both_key_sets(spark):
    left, right = frame(spark, [(1,), (2,)], "a int"), frame(spark, [(1, "x")], "b int, v string")
    assert rows(J.left_join_on(left, right, "a", "b")) == [(1, 1, "x"), (2, None, None)]
    same = J.left_join_on(left, right.withColumnRenamed("b", "a"), "a", "a")
    assert same.columns == ["a", "a_right", "v"]


def test_lookup_join_takes_one_row_and_ignores_null_keys(spark):
    left = frame(spark, [(1,), (None,), (3,)], "k int")
    right = frame(spark, [(1, 2, "b"), (1, 1, "a"), (None, 1, "n")], "k int, o int, v string")
    assert rows(J.lookup_join(left, right, "k", order_by="o")) == [(1, 1, "a"), (3, None, None), (None, None, None)]
    by_names = J.lookup_join(left, right.withColumnRenamed("k", "rk"), left_keys="k", right_keys="rk", order_by="o")
    assert by_names.columns == ["k", "o", "v"]


def test_anti_join_uses_every_key(spark):
    left = frame(spark, [(1, 1), (1, 2), (None, 1)], "a int, b int")
    right = frame(spark, [(1, 1), (None, 1)], "a int, b int")
    assert rows(J.anti_join(left, right, ["a", "b"])) == [(1, 2), (None, 1)]


def test_surrogate_lookup(spark):
    source = frame(spark, [("x", 10), ("y", 20)], "code string, amount int")
    lookup = frame(spark, [("x", 7, "noise")], "natural string, sk int, other string")
    out = J.surrogate_lookup(source, lookup, ["natural"], "sk", "code_fk", ["code"])
    assert out.columns == ["amount", "code_fk"] and rows(out) == [(10, 7), (20, None)]
    with pytest.raises(ValueError):
        J.surrogate_lookup(source, lookup, ["natural"], "sk", "code_fk", ["code", "amount"])


def test_quarantine_only_for_the_named_table(spark):
    df = frame(spark, [(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    errors = frame(spark, [("t", '{"k": 1}'), ("other", '{"k": 2}'), ("other", "broken")], "table_name string, primary_keys string")
    assert rows(J.exclude_quarantined(df, errors, "t", "k")) == [(2, "b"), (None, "c")]


def test_parent_id_collapses_copies(spark):
    child = frame(spark, [(1, 5, None), (1, 5, None), (2, 6, None), (3, None, 9)], "id int, nk int, pid int")
    parent = frame(spark, [(5, 100), (5, 100), (None, 1)], "n int, pid int")
    assert rows(J.propagate_parent_id(child, parent, [("nk", "n")], "pid")) == [(1, 5, 100), (2, 6, None), (3, None, None)]


def test_semi_changed_with_several_stored_hashes(spark):
    source = frame(spark, [(1, "a"), (2, "b"), (3, "c"), (4, None)], "k int, h string")
    target = frame(spark, [(1, "a"), (2, "b"), (2, "x"), (4, "d"), (None, "z")], "k int, h string")
    assert rows(J.semi_changed(source, target, "k", "h")) == [(2, "b")]


def test_effective_join_keeps_facts_without_a_valid_row(spark):
    day = lambda s: dt.datetime.fromisoformat(s)
    dim = frame(spark, [
        (1, 10, day("2000-01-01"), None, day("9999-12-31")),
        (2, 20, day("2000-01-01"), day("2010-01-01"), day("9999-12-31")),
        (3, 30, day("2000-01-01"), None, day("2005-01-01")),
        (4, 40, day("2020-01-01"), None, day("9999-12-31")),
    ], "d int, org int, EFFT_DTM timestamp_ntz, TERM_DTM timestamp_ntz, END_DTM timestamp_ntz")
    fact = frame(spark, [(i,) for i in range(1, 6)], "f int")
    out = J.effective_join(fact, dim, "f", "d", dt.datetime(2020, 7, 1), take=["org"])
    # the start of the year is after the first day only when it began earlier
    assert rows(out) == [(1, 10), (2, None), (3, None), (4, None), (5, None)]


# ------------------------------------------------------------ windows, groups


def test_assign_sequence_equals_dense_rank_with_nulls_and_copies(spark):
    df = frame(spark, [("b",), ("a",), (None,), ("b",), ("c",), (None,)], "k string")
    got = rows(W.assign_sequence(df, "k", "n", start=10))
    assert got == sorted([("a", 12), ("b", 13), ("b", 13), ("c", 14), (None, 11), (None, 11)], key=repr)


def test_number_rows_over_many_buckets(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    out = W.number_rows(df, "v", "n", buckets=13)
    assert out.filter(F.col("n") != F.col("v") + 1).count() == 0 and out.count() == 1000


def test_first_per_group_breaks_ties_by_the_other_columns(spark):
    df = frame(spark, [(1, 1, "b"), (1, 1, "a"), (2, 5, "z")], "k int, o int, v string")
    assert rows(W.first_per_group(df, "k", "o")) == [(1, 1, "a"), (2, 5, "z")]


def test_min_over_groups_nulls(spark):
    df = frame(spark, [(None, 3), (None, 1), (1, 5)], "k int, v int")
    assert rows(W.min_over(df, "k", "v", "m")) == [(1, 5, 5), (None, 1, 1), (None, 3, 1)]


def test_pivot_concat_pieces_join_to_the_cell(spark):
    data = [(1, "a", i % 40) for i in range(95)] + [(1, "b", 3)] + [(2, "a", 7), (2, "b", 8)]
    df = frame(spark, data, "k int, c string, v int").repartition(5)
    out = A.pivot_concat(df, "k", "c", "v", ["a", "b"], page_rows=10)
    assert [tuple(r) for r in out.filter("k = 2").collect()] == [(2, 0, "7", "8")]
    pieces = [r for r in out.filter("k = 1").orderBy("part").collect()]
    assert [r["part"] for r in pieces] == list(range(10)) and all(len(r["a"].split(",")) == 10 for r in pieces[:-1])
    assert ",".join(r["a"] for r in pieces) == ",".join(map(str, sorted(i % 40 for i in range(95))))
    whole = A.pivot_concat(df, "k", "c", "v", ["a", "b"], page_rows=1000).filter("k = 1").first()
    assert whole["a"] == ",".join(r["a"] for r in pieces) and whole["b"] == "3"


def test_pivot_concat_skips_nulls_and_leaves_empty_cells(spark):
    df = frame(spark, [(1, "a", None), (1, "b", "x"), (2, "a", "y")], "k int, c string, v string")
    assert rows(A.pivot_concat(df, "k", "c", "v", ["a", "b"], page_rows=5)) == [(1, 0, "", "x"), (2, 0, "y", "")]


def test_pack_json_is_sorted(spark):
    df = frame(spark, [(1, 2, "b"), (1, 1, "a"), (2, 1, None)], "k int, n int, v string")
    assert rows(A.pack_json(df, "k", ["n", "v"], "j", page_rows=5)) == [(1, 0, '[{"n":1,"v":"a"},{"n":2,"v":"b"}]'), (2, 0, '[{"n":1}]')]
    assert rows(A.pack_json(df, "k", ["n", "v"], "j", page_rows=1))[:2] == [(1, 0, '[{"n":1,"v":"a"}]'), (1, 1, '[{"n":2,"v":"b"}]')]


# ------------------------------------------------------------------------ sets


def test_complement_is_distinct_by_name_and_null_safe(spark):
    left = frame(spark, [(1, "a"), (1, "a"), (2, None), (3, None)], "k int, v string")
    right = frame(spark, [(None, 3)], "v string, k int")
    assert rows(S.complement(left, right)) == [(1, "a"), (2, None)]
    assert rows(S.common_rows(left, right)) == [(3, None)]


def test_two_way_minus_counts_copies(spark):
    left, right = frame(spark, [(1,), (1,), (2,)], "k int"), frame(spark, [(1,), (3,), (None,)], "k int")
    assert rows(S.two_way_minus(left, right)) == [
        ("source", 1, 1), ("source", 1, 2), ("target", 1, 3), ("target", 1, None),
    ]


def test_frames_equal(spark):
    a, b = frame(spark, [(1, None), (2, "x")], "k int, v string"), frame(spark, [("x", 2), (None, 1)], "v string, k int")
    assert rows(S.frames_equal(a, b)) == [(True, 0, 0)]
    assert rows(S.frames_equal(a, a.union(a))) == [(False, 0, 2)]
    with pytest.raises(ValueError):
        S.frames_equal(a, a.drop("v"))


def test_sample_is_repeatable_and_distinct(spark):
    df = spark.range(500).select((F.col("id") % 100).alias("k"))
    one, two = rows(S.sample_keys(df, "k", 20, seed=1)), rows(S.sample_keys(df, "k", 20, seed=1))
    assert one == two and len(set(one)) == 20
    assert rows(S.sample_keys(df, "k", 20, seed=2)) != one


# --------------------------------------------------------------------- run log


def test_sla_edges(spark):
    base = dt.datetime(2024, 1, 1)
    data = [(base, base + dt.timedelta(seconds=s), limit) for s, limit in [(59, "00:01:00"), (60, "00:01:00"), (1, ""), (1, None)]]
    df = frame(spark, data, "a timestamp_ntz, b timestamp_ntz, sla string")
    assert [r["sla_met"] for r in runlog.sla_met(df, "a", "b", "sla").collect()] == ["true", "false", "not applicable", "not applicable"]


def test_ola_edges(spark):
    at = lambda h, m, s: dt.datetime(2024, 1, 1, h, m, s)
    window = "01:00:00 - 03:00:00"
    df = frame(spark, [(at(1, 0, 0), window), (at(3, 0, 0), window), (at(3, 0, 1), window), (at(2, 0, 0), ""), (at(2, 0, 0), None)],
               "a timestamp_ntz, ola string")
    assert [r["blocked"] for r in runlog.ola_blocked(df, "a", "ola").collect()] == [True, True, False, False, False]


def test_last_success_defaults_to_1900(spark):
    df = frame(spark, [("p", "FAILURE", dt.datetime(2024, 1, 1)), ("q", "SUCCESS", dt.datetime(2024, 1, 2))],
               "pipeline_id string, job_status string, execution_start_dttm timestamp_ntz")
    assert rows(runlog.last_success(df, "pipeline_id")) == [("p", dt.datetime(1900, 1, 1)), ("q", dt.datetime(2024, 1, 2))]


def test_log_rows_latest(spark):
    start = runlog.started("p", "e1", dt.datetime(2024, 1, 1), table_name="t")
    end = runlog.finished(start, dt.datetime(2024, 1, 1, 1), error="boom")
    log = runlog.log_rows(spark, [end, start])
    last = runlog.latest_runs(log, ["pipeline_id", "execution_id"], "logged_at").first()
    assert last["job_status"] == "FAILURE" and last["landing_count"] is None and last["error_message"] == "boom"


@pytest.mark.parametrize("kind", ["int", "bigint", "smallint", "decimal(10,2)", "double", "float", "boolean", "date"])
def test_safe_cast_equals_try_cast(spark, kind):
    from millrace.functions.types import safe_cast

    texts = ["1", " 7 ", "+3", "-4", "\t5\n", "1.", ".5", "1.5", "1e3", "1E-2", "1d", "2F", "0x1p3", "NaN", "inf", "-Infinity", "x",
             "", " ", "1-URGENT", "t", "Yes", "no", "0", "TRUE", "99999999999999999999", "1_000", "2024-01-31", "--1", None]
    df = frame(spark, [(t,) for t in texts], "t string")
    got = df.select("t", safe_cast(F.col("t"), "string", kind).cast("string").alias("a"), F.col("t").try_cast(kind).cast("string").alias("b"))
    assert got.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def test_pivot_of_nothing_comes_back(spark):
    df = frame(spark, [], "k int, c string, v int")
    assert A.pivot_table(df, "k", "c", "v", "sum").columns == ["k", "c", "v"]
    assert A.pivot_table(df, "k", "c", "v", "sum", ["a"]).columns == ["k", "a"]
