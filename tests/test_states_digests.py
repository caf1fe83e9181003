"""Stored rule states, frequent values and the digest tree."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import digests as D
from millrace.operators import quality as Q
from millrace.operators import states as S

RULES = [
    Q.Rule("isComplete", "k"), Q.Rule("hasCompleteness", "t", (0.5,)), Q.Rule("isNonNegative", "k"), Q.Rule("isPositive", "k"), Q.Rule("hasMin", "d", ("2024-01-01",)),
    Q.Rule("hasMax", "k", (499,)), Q.Rule("isContainedIn", "t", (["a", "b"], 0.6)), Q.Rule("hasPattern", "t", ("^[a-c]$",)), Q.Rule("hasDataType", "t", ("int",)),
    Q.Rule("satisfies", "k", ("k >= 10", 0.9)),
]


def day(spark, first, last):
    at = F.lit(dt.date(2024, 1, 1)) + (F.col("id") % 5).cast("int")
    text = F.when(F.col("id") % 4 < 3, F.element_at(F.array(*[F.lit(c) for c in "abc"]), (F.col("id") % 3 + 1).cast("int")))
    return spark.range(first, last).select(F.col("id").alias("k"), text.alias("t"), at.alias("d"))


def counted(df, spark):
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(passing, df.schema), seen


def test_states_of_parts_give_the_result_of_the_whole(spark, tmp_path):
    path, one, two = str(tmp_path), day(spark, 0, 300), day(spark, 300, 501)
    first, seen = counted(one, spark)
    S.store_states(S.measure(first, RULES), path, "2024-01-01")
    assert seen.value == 300
    second, later = counted(two, spark)
    S.store_states(S.measure(second, RULES), path, "2024-01-02")
    S.store_states(S.measure(two, RULES), path, "2024-01-02")  # a repeated run replaces its own
    found = S.verify_states(S.read_states(spark, path), RULES, one.schema)
    assert rows(found) == rows(Q.verify(one.unionByName(two), RULES))
    assert (seen.value, later.value) == (300, 201) and S.stored_partitions(spark, path) == ["2024-01-01", "2024-01-02"]
    assert {r["constraint_status"] for r in found.collect()} == {"Success", "Failure"}


def test_sketches_are_near_the_truth(spark):
    df = spark.range(40_000).select((F.col("id") % 20_000).alias("k"), (F.col("id") % 8).alias("part"))
    rules = [Q.Rule("hasApproxCountDistinct", "k", (19_000, 21_000)), Q.Rule("hasApproxQuantile", "k", (0.5, 9_500, 10_500)), Q.Rule("hasApproxQuantile", "k", (0.9, 0, 10))]
    stored = S.measure(df, rules, by="part")
    assert stored.count() == 8
    for found in (S.verify_states(stored, rules, df.schema), Q.verify(df, rules)):
        assert [r["constraint_status"] for r in found.collect()] == ["Success", "Success", "Failure"]


def test_unmeasured_rules_stop_and_empty_tables_pass(spark, tmp_path):
    one = day(spark, 0, 10)
    with pytest.raises(ValueError, match="all rows"):
        S.measure(one, [Q.Rule("isUnique", "k")])
    S.store_states(S.measure(one, RULES[:2]), str(tmp_path), "1")
    with pytest.raises(ValueError, match="never measured"):
        S.verify_states(S.read_states(spark, str(tmp_path)), RULES[:3] + RULES[6:7], one.schema)
    S.store_states(S.measure(one, RULES[:3] + RULES[6:7]), str(tmp_path), "2")
    with pytest.raises(Exception, match="not measured in every"):
        S.verify_states(S.read_states(spark, str(tmp_path)), RULES[6:7], one.schema).collect()
    none = one.limit(0)
    assert rows(S.verify_states(S.measure(none, RULES), RULES, none.schema)) == rows(Q.verify(none, RULES))


def test_frequent_values_among_many(spark):
    rare = F.when(F.col("id") % 20 == 0, F.concat(F.lit("x"), "id"))
    df = spark.range(60_000).select(
        F.coalesce(rare, F.when(F.col("id") % 3 == 0, F.lit("it's")).otherwise(F.lit("b"))).alias("t"), F.col("id").cast("string").alias("u"),
        F.lit(None).cast("string").alias("z"), (F.col("id") % 2).cast("string").alias("all"),
    )
    found = Q.suggest(df, list_share=0.9).where("rule = 'isContainedIn'").collect()
    assert [(r["source_col_name"], r["dq_rule"]) for r in found] == [("t", """.isContainedIn("t", ['b', 'it\\'s'], 0.94)""")]
    plan = Q.profile(df, frequent=0.005)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[t" not in plan
    rule = Q.parse_rule("isContainedIn(['b', 'it\\'s'], 0.94)", "t")
    assert Q.verify(df, [rule]).first()["constraint_status"] == "Success"
    assert Q.suggest(df.limit(0), list_share=0.9).count() == 0


def table(spark, n=100_000):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"), F.col("id").cast("string").alias("v"))


def test_one_changed_cell_joins_one_leaf(spark):
    source = table(spark)
    target = source.withColumn("v", F.when(F.col("k") == 61_803, F.lit(None)).otherwise(F.col("v")))
    found, points = D.differing_leaves(source, target, "k")
    assert len(found) == 1 and len(points) == D.RANGES - 1
    assert 0 < D.in_leaves(source, ["k"], found, points).count() < 100
    assert rows(D.tree_diff(source, target, "k")) == rows(Q.cell_diff(source, target, "k")) == [(61_803, 0, None, ["v"])]
    assert D.trees_equal(source, source.repartition(5), "k") and not D.trees_equal(source, target, "k")
    assert D.tree_diff(source, source, "k").count() == 0


def test_bounds_reach_the_scan(spark, tmp_path):
    table(spark, 5_000).write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    target = source.withColumn("g", F.when(F.col("k") == 4_000, F.lit(9)).otherwise(F.col("g")))
    found, points = D.differing_leaves(source, target, "k")
    plan = D.in_leaves(source, ["k"], found, points)._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual(k,{points[found[0][0] - 1]})" in plan


def test_tree_against_cell_diff_on_other_keys(spark):
    data = [(None, 1, "a"), ("x", 1, None), ("x", 2, "b"), ("ü", None, "c")] + [("hot", k, str(k)) for k in range(500)]
    source = spark.createDataFrame(data, "s string, n int, v string")
    target = spark.createDataFrame([(s, n, "z" if n in (2, 77) else v) for s, n, v in data[:400]] + [("new", 1, "q")], source.schema)
    keys = ["s", "n"]
    good = lambda df: df.where("s IS NOT NULL AND n IS NOT NULL")  # noqa: E731  cell_diff stops at null keys
    assert rows(D.tree_diff(good(source), good(target), keys)) == rows(Q.cell_diff(good(source), good(target), keys))
    assert rows(D.tree_missing(source, target, keys)) == rows(Q.missing_keys(source, target, keys))
    swapped = source.withColumns({"s": F.col("v"), "v": F.col("s")}).where("s IS NOT NULL")
    assert not D.trees_equal(source, swapped, keys)
    dates = spark.range(1000).select((F.lit(dt.date(2024, 1, 1)) + F.col("id").cast("int")).alias("d"), F.col("id").alias("v"))
    assert rows(D.tree_diff(dates, dates.withColumn("v", F.col("v") + (F.col("v") == 500).cast("int")), "d"), "v") == [(501,)]
