"""One key holds half of the rows: results stay whole and the work is split."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import cdc
from millrace.operators import filters as L
from millrace.operators import joins as J
from millrace.operators import quality as Q
from millrace.operators import windows as W
from millrace.operators.sets import frames_equal

ROWS, HOT = 120_000, 60_000


@pytest.fixture
def skewed(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    key = F.when(F.col("id") < HOT, F.lit(7)).otherwise(F.col("id") % 5000).cast("bigint")
    facts = spark.range(0, ROWS, 1, 8).select(key.alias("k"), "id", F.md5(F.col("id").cast("string")).alias("v"))
    keys = spark.range(0, 4000, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    return facts, keys


def _plan(df) -> str:
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


def _change(keys, **extra):
    df = keys.filter("k <> 7").select("k", F.col("w").alias("id"), F.lit("x").alias("v"))
    return df.withColumns({n: F.lit(v) for n, v in extra.items()})


CASES = {
    "anti": lambda f, k: J.anti_join(f, k.filter("k <> 7"), "k"),
    "lookup": lambda f, k: J.lookup_join(f, k, "k", order_by="w"),
    "left": lambda f, k: J.left_join(f, k, "k"),
    "inner": lambda f, k: J.inner_join(f, k, "k"),
    "delete": lambda f, k: L.delete_by_key(f, "k", k.filter("k <> 7").select("k")),
    "min_over": lambda f, k: W.min_over(f, "k", "id", "m"),
    "sequence": lambda f, k: W.assign_sequence(f, "k", "n"),
    "indicator": lambda f, k: cdc.merge_by_indicator(f, _change(k, op="UPD"), "k", "op"),
    "upsert": lambda f, k: cdc.upsert(f, _change(k), "k"),
    "parent": lambda f, k: J.propagate_parent_id(f, k, [("k", "k")], "w", distinct=False),
    "changed": lambda f, k: J.semi_changed(f, k.select("k", F.col("w").cast("string").alias("v")), "k", "v"),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_hot_key_is_split(skewed, name):
    assert "skew=true" in _plan(CASES[name](*skewed))


def _sides(spark, left, right):
    a = spark.createDataFrame(left, "k int, n int, a string")
    return a, spark.createDataFrame(right, "n int, b string, k int")


@pytest.mark.parametrize("how", ["left_join", "outer_join"])
def test_hot_outer_joins_equal_plain_ones(spark, how):
    left = [(1, 1, f"a{i}") for i in range(3)] + [(2, 1, f"b{i}") for i in range(50)] + [(3, 1, "c"), (8, 1, "l")]
    left += [(None, 1, "n")] * 30 + [(1, None, "m")]
    left += [(9, 1, "only left")] * 40
    right = [(1, f"x{i}", 1) for i in range(60)] + [(1, "same", 1)] * 30 + [(1, "y", 2), (1, "z", 3), (None, "n", 1)] + [(1, "n", None)] * 30
    right += [(1, "only right", 7)] * 45 + [(2, "other", 8), (1, "q", 99)]
    a, b = _sides(spark, left, right)
    join = getattr(J, how)
    plain, hot = join(a, b, ["k", "n"]), join(a, b, ["k", "n"], hot_rows=20)
    assert plain.columns == hot.columns and frames_equal(plain, hot).first()["is_equal"]
    calm = join(a, b, ["k", "n"], hot_rows=1000)
    assert frames_equal(plain, calm).first()["is_equal"]


@pytest.mark.parametrize("how", ["left_join", "outer_join"])
def test_outer_joins_find_their_hot_keys(spark, conf, how):
    """Half of the rows have one key on either side; nothing is named."""
    conf(spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB", spark__sql__shuffle__partitions="6")
    k = lambda hot: F.when(F.col("id") % 2 == 0, F.lit(hot)).when(F.col("id") % 11 == 3, F.lit(None)).otherwise(F.col("id"))
    left = spark.range(9_000).select(k(5).alias("k"), F.col("id").alias("a"))
    right = spark.range(7_000).select(k(7).alias("k"), F.col("id").alias("b"))
    found = [{r["k"]: r[J.SLOTS] for r in f.collect()} for f in J.measured_keys([left, right], ["k"], 6)]
    assert found == [{5: 4}, {7: 4}] or found == [{5: 3}, {7: 3}]
    out = getattr(J, how)(left, right, "k")
    assert "_slot" in out._jdf.queryExecution().toString()
    conf(spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1GB")
    plain = getattr(J, how)(left, right, "k")
    assert "_slot" not in plain._jdf.queryExecution().toString()
    assert frames_equal(plain, out).first()["is_equal"]


def test_min_over_is_whole(skewed):
    facts, _ = skewed
    out = W.min_over(facts, "k", "id", "m")
    assert out.count() == ROWS and out.filter("k = 7 AND m <> 0").count() == 0


def test_sequence_is_whole(skewed):
    facts, _ = skewed
    out = W.assign_sequence(facts, "k", "n")
    assert out.count() == ROWS and out.select("k", "n").distinct().count() == facts.select("k").distinct().count()


def test_pages_of_a_hot_group_stay_small_and_whole(spark, skewed):
    facts, _ = skewed
    paged = A.with_pages(facts, ["k"], [F.col("id")], 1000)
    sizes = paged.groupBy("k", "part").count()
    assert sizes.agg(F.sum("count")).first()[0] == ROWS
    assert sizes.agg(F.max("count")).first()[0] == 1000
    assert sizes.filter("k <> 7 AND part <> 0").count() == 0


def test_pages_split_a_group_of_copies(spark):
    data = spark.range(5000).select(F.lit(1).alias("k"), F.when(F.col("id") < 4000, -1).otherwise(F.col("id")).alias("v"))
    paged = A.with_pages(data, ["k"], [F.col("v")], 100)
    sizes = [r["count"] for r in paged.groupBy("part").count().collect()]
    assert sizes == [100] * 50
    packed = A.pack_json(data, "k", ["v"], "j", page_rows=100)
    values = [v["v"] for r in packed.orderBy("part").collect() for v in json.loads(r["j"])]
    assert len(values) == 5000 and values.count(-1) == 4000 and values == sorted(values)


def test_group_of_copies_collapses_in_unique_rows(spark):
    df = spark.range(50_000).select(F.lit("a").alias("k"), F.lit("same").alias("v"))
    assert rows(cdc.unique_rows(df, "k")) == [("a", "same")]


def test_crosswalk_tasks_stay_small_and_whole(spark, monkeypatch):
    """As many tasks as the rows ask for, one look for copies, and copies of a row stay apart from the others."""
    from millrace.operators import sets as S

    monkeypatch.setattr(S.distinct_rows, "__defaults__", (1000,))
    once = spark.range(20_000).select(F.when(F.col("id") % 9 > 0, F.col("id") % 5000).alias("n"), "id")
    many = spark.range(30_000).select(F.lit(1).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("id"))
    lookup = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (3, "c"), (None, "d")], "ref bigint, name string")
    facts = once.unionByName(many)
    out = J.crosswalk(facts, lookup, "n", "ref", "name")
    plan = _plan(out)
    assert "REPARTITION_BY_NUM" in plan and plan.count("HashAggregate") <= 12
    wanted = facts.distinct().join(lookup.distinct(), F.col("n") == F.col("ref"), "left").select("n", "id", "name").distinct()
    assert frames_equal(out, wanted).first()["is_equal"]
    whole = S.distinct_rows(facts)
    assert whole.count() == 20_001 and whole.rdd.glom().map(len).max() < 2000
    texts = spark.createDataFrame([("1", "a"), ("01", "a")], "ref string, name string")
    assert J.crosswalk(facts, texts, "n", "ref", "name").where("name = 'a'").groupBy("n", "id").count().where("count > 1").isEmpty()


def test_type_2_run_exchanges_its_rows_once(spark, conf):
    """What a run returns is read as stored: neither exchanged nor joined again, also where nothing is small enough to broadcast by plan."""
    conf(spark__sql__autoBroadcastJoinThreshold="100k")
    day = lambda m: dt.date(2024, m, 1)
    source = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    stored = cdc.scd2_initial(source, "k", "sk", day(1), one_per_key=True)
    assert "hashpartitioning(_bucket" not in _plan(stored)
    more = source.withColumn("v", F.when(F.col("v") < 100, -1).otherwise(F.col("v"))).unionByName(source.withColumn("k", F.concat("k", F.lit("-N"))))
    out = cdc.scd2_merge(stored, more, "k", "sk", day(2))
    assert "hashpartitioning" not in _plan(out)
    counts = out.agg(F.count("*"), F.countDistinct("sk"), F.max("sk"), F.count_if(F.col("end_dt") < day(2))).first()
    assert tuple(counts) == (100_100, 100_000, 100_000, 100)
    order = out.where("sk > 50000").select((F.col("sk") - 50_000).alias("n"), F.row_number().over(Window.orderBy("k")).alias("m"))
    assert order.where("n = m").count() == 50_000


def test_later_run_gives_new_children_the_last_parent(spark):
    from millrace.plans.chains import Level, scd2_chain

    levels = (Level("p", "pk", "p_sk"), Level("c", "ck", "c_sk", on=[("ref", "nat")], on_duplicate="latest", order_by=["v"]))
    parents = spark.createDataFrame([("p1", 1), ("p2", 1), ("p3", 2)], "pk string, nat int")
    one = {"p": parents, "c": spark.createDataFrame([("c1", 1, 0), ("c1", 2, 1), ("c2", 9, 0)], "ck string, ref int, v int")}
    two = {"p": parents, "c": spark.createDataFrame([("c1", 1, 5), ("c2", 9, 0), ("c3", 1, 0), ("c3", 1, 0), ("c4", None, 0)], "ck string, ref int, v int")}
    first = scd2_chain(levels, one, dt.date(2024, 1, 1))
    second = scd2_chain(levels, two, dt.date(2024, 2, 1), targets=first)["c"]
    assert rows(first["c"], "ck", "ref", "p_sk", "c_sk") == [("c1", 2, 3, 1), ("c2", 9, None, 2)]
    assert rows(second, "ck", "ref", "v", "p_sk", "c_sk") == [
        ("c1", 1, 5, 3, 1), ("c1", 2, 1, 3, 1), ("c2", 9, 0, None, 2), ("c3", 1, 0, 2, 3), ("c4", None, 0, None, 4)
    ]


def test_uniqueness_with_a_hot_value(skewed):
    facts, _ = skewed
    result = Q.verify(facts, [Q.Rule("isUnique", "k"), Q.Rule("isUnique", "id")]).collect()
    assert [r["constraint_status"] for r in result] == ["Failure", "Success"]


def test_plain_operators_do_not_shuffle(spark, skewed):
    from millrace.operators import columns as C

    facts, _ = skewed
    out = C.convert_when(C.add_fields(facts, [["a", 1]]), "v", F.upper, "k = 7")
    assert "Exchange" not in _plan(out)


def test_filters_and_columns_reach_the_scan(spark, tmp_path, skewed):
    facts, _ = skewed
    facts.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = _plan(L.select_rows(stored, "k = 7").select("id"))
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,7)]" in plan and "ReadSchema: struct<k:bigint,id:bigint>" in plan
