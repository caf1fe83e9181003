"""Change capture: small cases by hand and laws on random data."""

import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.operators.sets import frames_equal

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
OPEN = dt.date(2999, 12, 31)
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def table(spark, data, schema="k string, v string"):
    return spark.createDataFrame(data, schema)


def test_indicator_merge(spark):
    target = table(spark, [("a", "1"), ("b", "2"), ("c", "3"), (None, "n")])
    changes = table(spark, [("a", "9", "UPD"), ("b", "2", "DEL"), ("d", "4", "INS"), ("c", "x", None), ("e", "5", "UPD")],
                    "k string, v string, op string").withColumn("rno", F.lit(1))
    assert rows(cdc.merge_by_indicator(target, changes, "k", "op")) == [
        ("a", "9"), ("c", "3"), ("d", "4"), ("e", "5"), (None, "n"),
    ]


def test_merge_with_no_changes_is_identity(spark):
    target = table(spark, [("a", "1"), ("a", "1"), (None, None)])
    none = table(spark, [], "k string, v string, op string")
    assert frames_equal(cdc.merge_by_indicator(target, none, "k", "op"), target).first()[0]
    assert frames_equal(cdc.upsert(target, none.drop("op"), "k"), target).first()[0]


def test_upsert_modes(spark):
    target = table(spark, [("a", "1"), ("b", "2"), ("b", "2")])
    changes = table(spark, [("a", "9"), ("b", "2"), ("c", "3")])
    assert rows(cdc.upsert(target, changes, "k")) == [("a", "9"), ("b", "2"), ("c", "3")]
    assert rows(cdc.upsert(target, changes, "k", "keep_versions")) == [("a", "1"), ("a", "9"), ("b", "2"), ("c", "3")]
    with pytest.raises(ValueError):
        cdc.upsert(target, changes, "k", "other")


def test_replace_stamped(spark):
    at = dt.datetime(2024, 1, 1, 2, 3, 4)
    changes = table(spark, [("a", "1")])
    first = cdc.replace_stamped(None, changes, "k", at)
    assert rows(first) == [("a", "1", at)]
    later = dt.datetime(2024, 1, 2)
    again = cdc.replace_stamped(first, table(spark, [("b", "2")]), "k", later)
    assert rows(again) == [("a", "1", later), ("b", "2", later)]


def test_unique_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("b", 1, "z")], "k string, o int, v string")
    assert rows(cdc.unique_rows(df, "k", "latest", "o")) == [("a", 2, "y"), ("b", 1, "z")]
    assert rows(cdc.unique_rows(df.filter("k = 'b'"), "k")) == [("b", 1, "z")]
    with pytest.raises(PySparkException, match="different rows"):
        cdc.unique_rows(df, "k").collect()
    with pytest.raises(PySparkException, match="null in key"):
        cdc.unique_rows(table(spark, [(None, "x")]), "k").collect()


def test_scd2_by_hand(spark):
    first = cdc.scd2_initial(table(spark, [("b", "1"), ("a", "1"), ("c", "1")]), "k", "sk", D1)
    assert rows(first) == [("a", "1", 1, D1, OPEN), ("b", "1", 2, D1, OPEN), ("c", "1", 3, D1, OPEN)]
    second = cdc.scd2_merge(first, table(spark, [("a", "1"), ("b", "2"), ("z", "0"), ("y", "0")]), "k", "sk", D2)
    assert rows(second) == [
        ("a", "1", 1, D1, OPEN), ("b", "1", 2, D1, dt.date(2024, 1, 31)), ("b", "2", 2, D2, OPEN),
        ("y", "0", 4, D2, OPEN), ("z", "0", 5, D2, OPEN),
    ]


def test_scd2_same_day_change_closes_on_that_day(spark):
    first = cdc.scd2_initial(table(spark, [("a", "1")]), "k", "sk", D1)
    again = cdc.scd2_merge(first, table(spark, [("a", "2")]), "k", "sk", D1)
    assert rows(again) == [("a", "1", 1, D1, D1), ("a", "2", 1, D1, OPEN)]


def test_scd2_missing_keys(spark):
    first = cdc.scd2_initial(table(spark, [("a", "1"), ("b", "1")]), "k", "sk", D1)
    source = table(spark, [("a", "1")])
    by = {m: rows(cdc.scd2_merge(first, source, "k", "sk", D2, on_missing=m), "k", "end_dt") for m in ("drop", "keep", "close")}
    assert by["drop"] == [("a", OPEN)]
    assert by["keep"] == [("a", OPEN), ("b", OPEN)]
    assert by["close"] == [("a", OPEN), ("b", dt.date(2024, 1, 31))]


def test_scd2_numbers_continue_after_history(spark):
    stored = spark.createDataFrame([("a", "1", 7, D1, D1), ("b", "1", 3, D1, OPEN)], "k string, v string, sk bigint, start_dt date, end_dt date")
    out = cdc.scd2_merge(stored, table(spark, [("b", "1"), ("n", "1")]), "k", "sk", D2)
    assert rows(out, "k", "sk") == [("a", 7), ("b", 3), ("n", 8)]


def test_scd2_null_value_against_text_is_a_change(spark):
    first = cdc.scd2_initial(spark.createDataFrame([("a", None, "x")], "k string, v string, w string"), "k", "sk", D1)
    moved = spark.createDataFrame([("a", "x", None)], "k string, v string, w string")
    assert cdc.scd2_merge(first, moved, "k", "sk", D2).count() == 2
    assert cdc.scd2_merge(first, moved, "k", "sk", D2, legacy_hash=True).count() == 1


def test_scd2_schema_evolution(spark):
    first = cdc.scd2_initial(spark.createDataFrame([("a", "1", "old")], "k string, v string, gone string"), "k", "sk", D1)
    out = cdc.scd2_merge(first, spark.createDataFrame([("a", "1", 5)], "k string, v string, extra int"), "k", "sk", D2)
    assert out.columns == ["k", "v", "extra", "sk", "start_dt", "end_dt"]
    assert rows(out) == [("a", "1", 5, 1, D2, OPEN), ("a", "1", None, 1, D1, dt.date(2024, 1, 31))]


def test_scd2_keeps_the_stored_parent_id(spark):
    schema = "k string, v string, pid bigint"
    first = cdc.scd2_initial(spark.createDataFrame([("a", "1", 10)], schema), "k", "sk", D1)
    out = cdc.scd2_merge(first, spark.createDataFrame([("a", "2", 99), ("n", "1", 98)], schema), "k", "sk", D2, parent_id="pid")
    assert rows(out, "k", "v", "pid") == [("a", "1", 10), ("a", "2", 10), ("n", "1", 98)]
    same = cdc.scd2_merge(first, spark.createDataFrame([("a", "1", 99)], schema), "k", "sk", D2, parent_id="pid")
    assert same.count() == 1


snapshots = st.dictionaries(st.sampled_from("abcdefgh"), st.sampled_from("xyz"), min_size=1, max_size=8)


def _replay(spark, states, on_missing):
    """The same semantics written out row by row."""
    days = [dt.date(2024, m, 1) for m in range(1, len(states) + 1)]
    versions, numbers = [], {}
    for day, state in zip(days, states):
        fresh = sorted(k for k in state if k not in {v[0] for v in versions if v[4] == OPEN})
        last = max((v[2] for v in versions), default=0)
        out = [v for v in versions if v[4] != OPEN]
        for key, value, number, start, _ in [v for v in versions if v[4] == OPEN]:
            closed = (key, value, number, start, day if start == day else day - dt.timedelta(days=1))
            if key not in state:
                if on_missing != "drop":
                    out.append(closed if on_missing == "close" else (key, value, number, start, OPEN))
            elif state[key] == value:
                out.append((key, value, number, start, OPEN))
            else:
                out += [closed, (key, state[key], number, day, OPEN)]
        out += [(k, state[k], last + i + 1, day, OPEN) for i, k in enumerate(fresh)]
        versions = out
    del numbers
    return sorted(versions, key=repr)


@FEW
@given(st.lists(snapshots, min_size=2, max_size=3), st.sampled_from(["drop", "keep", "close"]))
def test_scd2_against_row_by_row_replay(spark, states, on_missing):
    stored = cdc.scd2_initial(table(spark, list(states[0].items())), "k", "sk", dt.date(2024, 1, 1))
    for month, state in enumerate(states[1:], start=2):
        stored = cdc.scd2_merge(stored, table(spark, list(state.items())), "k", "sk", dt.date(2024, month, 1), on_missing)
    got = rows(stored)
    assert got == _replay(spark, states, on_missing)
    open_keys = [r[0] for r in got if r[4] == OPEN]
    assert len(open_keys) == len(set(open_keys))


@FEW
@given(snapshots, snapshots)
def test_scd2_twice_with_the_same_source_adds_nothing(spark, one, two):
    first = cdc.scd2_initial(table(spark, list(one.items())), "k", "sk", D1)
    source = table(spark, list(two.items()))
    second = cdc.scd2_merge(first, source, "k", "sk", D2)
    third = cdc.scd2_merge(second, source, "k", "sk", D3)
    assert rows(third) == rows(second)


def test_satellite(spark):
    schema = "id int, a string, diff_hash string, load_dtm string"
    stored = spark.createDataFrame([(1, "x", "hx", "1")], schema)
    source = spark.createDataFrame([(1, "x", "hx", "2"), (1, "y", "hy", "2"), (2, "x", "hx", "2"), (2, "x", "hx", "2")], schema)
    out = cdc.satellite_append(stored, source, "id", ["a"])
    assert rows(out) == [(1, "x", "hx", "1"), (1, "y", "hy", "2"), (2, "x", "hx", "2")]
    assert rows(cdc.satellite_append(out, source.withColumn("load_dtm", F.lit("3")), "id", ["a"])) == rows(out)


def test_hash_keys_do_not_depend_on_the_listed_order(spark):
    df = spark.createDataFrame([("k", "a", None)], "id string, x string, y string")
    one, two = cdc.with_hash_keys(df, "id", ["x", "y"]), cdc.with_hash_keys(df, "id", ["y", "x"])
    assert rows(one) == rows(two)


def test_daily_windows(spark):
    at = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 3, 5)
    df = spark.createDataFrame([("p", *at), ("q", at[0], at[0])], "id string, a timestamp_ntz, b timestamp_ntz")
    assert rows(cdc.daily_windows(df, "a", "b", ["id"]), "id", "window_from", "window_till", "till_included") == [
        ("p", dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2), False),
        ("p", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), False),
        ("p", dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 3, 5), True),
        ("q", at[0], at[0], True),
    ]
