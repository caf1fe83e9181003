"""The stages over the smallest tables, each against what its operator promises."""

from collections import Counter
from functools import reduce

from conftest import DATA
from pyspark.sql import functions as F
from test_fmindex import plain_hits
from test_simhash import plain_similar

import corpus_pipeline as pipeline


def test_stages_over_the_smallest_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, kept[-1], DATA).write.parquet(str(tmp_path / str(k)))
        kept.append(spark.read.parquet(str(tmp_path / str(k))))
        if k < 4:
            assert kept[-1].columns == columns and kept[-1].dtypes == docs.dtypes
    rows = [{r["doc_id"]: r for r in df.collect()} for df in kept[:4]]
    assert set(rows[1]) <= set(rows[0]) and len(rows[1]) >= 0.9 * len(rows[0])
    assert sorted(rows[2], key=repr) == plain_similar([(d, r["text"]) for d, r in rows[1].items()])
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    for d, r in rows[2].items():
        words, hit, _ = plain_hits(r["text"], items)
        if not hit:
            assert rows[3][d] == r
        elif len(hit) == len(words):
            assert d not in rows[3]
        else:
            assert rows[3][d]["text"] != r["text"] and rows[3][d]["n_chars"] == len(rows[3][d]["text"])
    mixed = Counter(r["doc_id"] for r in kept[4].collect())
    assert set(mixed) <= set(rows[3]) and max(mixed.values()) <= 3
    sharded = kept[5].collect()
    assert Counter(r["doc_id"] for r in sharded) == mixed
    sizes = Counter(r["shard"] for r in sharded)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 1


def test_run_repeats(spark):
    first, second = (sorted(r["doc_id"] for r in pipeline.run(spark, DATA).collect()) for _ in range(2))
    assert first == second and first


def test_extra_columns_come_through_every_stage(spark, tmp_path):
    names = ["_check", "_gone", "_gone_id", "_text", "_cut", "size", "source_size", "target", "repeats", "_copy", "row", "number", "language", "kept"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")))
    for k, (_, stage) in enumerate(pipeline.STAGES):
        columns = docs.columns
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns
        wrong = [F.col(n) != F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in names]
        assert docs.where(reduce(lambda a, b: a | b, wrong)).count() == 0
