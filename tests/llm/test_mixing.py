"""Operator 1 on small sources."""

from pyspark.sql import functions as F

from millrace.llm import mixing
from millrace.llm.common import word_count

SCHEMA = "doc_id bigint, source string, text string, size string, whole string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "s", "w") for r in rows], SCHEMA)


def mix(docs, **settings):
    return mixing.mix_sources(
        docs, None, size=word_count(F.col("text")), identity=F.col("doc_id"), source=F.col("source"), **settings
    )


def test_word_count(spark):
    texts = ["", " ", "a", " a\tb\x0b c\r\n", " ", "x" * 5000 + "  y", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    counts = [r[0] for r in df.select(word_count(F.col("t"))).collect()]
    assert counts == [0, 0, 1, 3, 1, 2, 0]


def test_water_filling_clamps_and_reshares(spark):
    sizes = spark.createDataFrame([("a", 10, 1.0), ("b", 100, 1.0), ("c", 1000, 4.0), ("d", 0, 1.0), ("e", 50, None)], "source string, source_size bigint, weight double")
    found = {r["source"]: r["target"] for r in mixing.water_fill(sizes, 1160, 3.0).collect()}
    # a and d stop at their caps; b at 300 as its share of the rest is above; c takes what is left
    assert found["a"] == 30 and found["d"] == 0 and found["e"] == 0
    assert found["b"] == 1130 / 5 and found["c"] == 4 * 1130 / 5


def test_targets_are_met_and_rows_stay_whole(spark):
    rows = [(k, s, "w " * (1 + k % 7)) for k, s in enumerate(["a", "b", "c", None] * 60)]
    rows += [(1000, "a", None), (1001, None, ""), (None, "b", "x y z"), (None, "b", "x y z"), (5, "b", "w " * 6)]
    docs = table(spark, rows)
    result = mix(docs)
    assert result.columns == ["doc_id", "source", "text", "whole", "size", "source_size", "target", "repeats"]
    found = result.collect()
    assert len(found) == len(rows)
    total = sum(len((r[2] or "").split()) for r in rows)
    by_source = {}
    for r in found:
        assert 0 <= r["repeats"] <= 3
        by_source.setdefault(r["source"], []).append(r)
    assert abs(sum(x[0]["target"] for x in by_source.values()) - total) < 1e-6
    for own in by_source.values():
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(sum(r["size"] * r["repeats"] for r in own) - own[0]["target"]) <= 12
    again = sorted(map(repr, mix(docs.repartition(5)).collect()))
    assert again == sorted(map(repr, found))
    taken = mixing.repeat_rows(result)
    assert taken.count() == sum(r["repeats"] for r in found)


def test_given_weights_total_and_caps(spark):
    docs = table(spark, [(k, "a" if k < 20 else "b", "w w") for k in range(40)])
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    found = mixing.mix_sources(
        docs, weights, size=F.lit(2), identity=F.col("doc_id"), source=F.col("source"), max_epochs=1.0, total=1000
    )
    assert {r["repeats"] for r in found.collect()} == {1}


def test_empty_and_wordless_tables(spark):
    assert mix(table(spark, [])).count() == 0
    assert [r["repeats"] for r in mix(table(spark, [(1, "a", None), (2, None, "")])).collect()] == [0, 0]
