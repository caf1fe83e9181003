"""Operator 5: exact sizes, gapless slots, and a fair draw."""

from collections import Counter

import numpy as np

from millrace.llm import sharding


def test_matrix_adds_up():
    counts, sizes = [5, 0, 17, 3], [7, 6, 6, 6]
    matrix = sharding.communication_matrix(counts, sizes, 1)
    assert [sum(line) for line in matrix] == counts
    assert [sum(column) for column in zip(*matrix)] == sizes


def test_large_draws_follow_the_distribution(monkeypatch):
    rng = np.random.Generator(np.random.PCG64(5))
    wanted = rng.hypergeometric(300, 700, 50, 20_000)
    monkeypatch.setattr(sharding, "NUMPY_LIMIT", 0)
    found = [sharding.draw_hypergeometric(rng, 300, 700, 50) for _ in range(20_000)]
    assert abs(np.mean(found) - np.mean(wanted)) < 0.1 and abs(np.var(found) - np.var(wanted)) < 0.4
    assert sharding.draw_hypergeometric(rng, 10**11, 7 * 10**11, 10**6) > 0
    assert sharding.draw_hypergeometric(rng, 5, 0, 3) == 3


def test_sizes_slots_and_rows(spark):
    rows = [(k % 90 if k % 11 else None, "t", k) for k in range(1003)] + [(1, "same", 0)] * 200
    docs = spark.createDataFrame(rows, "doc_id bigint, slot string, part int").repartition(7)
    found = sharding.shard_rows(docs, 8, rows_per_bucket=40)
    assert found.columns == ["doc_id", "part", "shard", "slot"]
    found = found.collect()
    assert Counter((r["doc_id"], r["part"]) for r in found) == Counter((d, p) for d, _, p in rows)
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_fewer_rows_than_shards_and_none(spark):
    few = spark.range(3).withColumnRenamed("id", "doc_id")
    assert sorted((r["shard"], r["slot"]) for r in sharding.shard_rows(few, 8).collect()) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shard_rows(few.limit(0), 8).count() == 0


def test_every_place_is_equally_likely(spark):
    docs = spark.range(40).repartition(4)
    hits = Counter()
    for seed in range(12):
        hits.update(r["shard"] for r in sharding.shard_rows(docs, 4, seed=seed).where("id < 10").collect())
    assert sum(hits.values()) == 120 and min(hits.values()) >= 12
