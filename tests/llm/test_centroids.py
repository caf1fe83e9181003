"""Operator 11: exact clusters, and bounds that hold for every point of a sphere."""

import hashlib
import math

import numpy as np
import pytest
from conftest import DATA

from millrace.llm import centroids as C


def plain_clusters(rows, k=40, rounds=5, dims=64, scale=256, seed=2):
    """The same in Python integers: [(id, cluster, distance)], centroids."""
    kept = [
        (i, [math.floor(scale * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for j, vs in members.items():
            cents[j] = [sum(x) // len(vs) for x in zip(*vs)]
    return [(i, *reversed(nearest(v))) for i, v in kept], cents


def test_whole_table_against_plain_rounds(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    log = []
    found = C.cluster_vectors(table, identity=table["vec_id"], embedding=table["embedding"], log=log).collect()
    wanted, cents = plain_clusters([(r["vec_id"], r["embedding"]) for r in table.collect()])
    assert sorted((r["vec"], r["cluster"], r["distance"]) for r in found) == sorted(wanted)
    assert {r["inertia"] for r in found} == {sum(d for _, _, d in wanted)}
    for r in found:
        assert r["cluster_inertia"] == sum(d for _, c, d in wanted if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cents[r["cluster"]])).encode()).hexdigest()
    assert log[0]["scanned"] == len(found) and all(step["rows"] == len(found) for step in log)
    assert log[-1]["scanned"] < len(found)


@pytest.mark.parametrize("spread", [0.1, 1.0, 30.0])
def test_no_point_of_a_sphere_comes_nearer_than_the_bound(spread):
    rng = np.random.default_rng(int(spread * 10))
    before = rng.integers(-300, 300, (6, 5))
    after = before + np.round(rng.normal(0, 40 * spread, before.shape)).astype(np.int64)
    after[2] = before[2]
    radii = rng.uniform(1, 300, 6)
    bound = C.loosening(before, after, radii)
    drift = np.sqrt(((after - before) ** 2).sum(axis=1))
    for i in range(6):
        others = [j for j in range(6) if j != i]
        steps = rng.normal(size=(4000, 5))
        points = before[i] + steps / np.linalg.norm(steps, axis=1)[:, None] * radii[i] * rng.uniform(0, 1, (4000, 1)) ** 0.2
        nearer = max(
            (np.linalg.norm(points - before[j], axis=1) - np.linalg.norm(points - after[j], axis=1)).max() for j in others
        )
        assert nearer <= bound[i] <= drift[others].max() * (1 + 1e-6) + 1e-3


def test_bounds_tighten_below_the_drift_and_may_rise():
    before = np.array([[0, 0], [1000, 0]])
    assert C.loosening(before, np.array([[0, 0], [1000, 100]]), [50, 50])[0] < 20 < 100
    assert C.loosening(before, np.array([[0, 0], [1100, 0]]), [50, 50])[0] < 0
    assert C.loosening(before, np.array([[0, 0], [900, 0]]), [50, 50])[0] == pytest.approx(100, abs=1e-3)


def test_well_separated_clusters_are_scanned_less(spark):
    rng = np.random.default_rng(4)
    rows = [(k, (rng.normal(0, 0.02, 3) + np.array([k % 4, k % 4 * 2, -(k % 4)])).tolist()) for k in range(4000)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>").repartition(6)
    log = []
    found = C.cluster_vectors(df, identity=df["id"], embedding=df["v"], k=12, rounds=6, dims=3, log=log).collect()
    wanted, _ = plain_clusters(rows, k=12, rounds=6, dims=3)
    assert sorted((r["vec"], r["cluster"], r["distance"]) for r in found) == sorted(wanted)
    assert sum(s["scanned"] for s in log[2:]) < 0.6 * sum(s["rows"] for s in log[2:])


def test_nulls_ties_repeats_large_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 1.0], 7), (2, [0.0, 1.0], 7), (2, [0.0, 1.0], 7), (3, [0.0, -1.0], 7), (None, [2.0, -1.25], 7), (None, [2.0, -1.25], 7), (4, None, 7),
        (5, [1.0], 7), (6, [1.0, None], 7), (7, [nan, 1.0], 7), (8, [inf, 1.0], 7), (9, [0.0, 0.0], 7), (10, [40000.5, -40000.25], 7),
    ]
    df = spark.createDataFrame(rows, "vec bigint, components array<double>, cluster int")
    for k in (1, 3, 40):
        found = C.cluster_vectors(df, identity=df["vec"], embedding=df["components"], k=k, dims=2).collect()
        wanted, _ = plain_clusters([r[:2] for r in rows], k=k, dims=2)
        assert sorted(((r["vec"], r["cluster"], r["distance"]) for r in found), key=repr) == sorted(wanted, key=repr)
    none = C.cluster_vectors(df.where("vec = 4"), identity=df["vec"], embedding=df["components"], dims=2)
    assert none.count() == 0 and none.columns == found[0].__fields__
    vast = spark.createDataFrame([(1, [1e30, 0.0])], "vec bigint, components array<double>")
    with pytest.raises(Exception, match="is beyond"):
        C.cluster_vectors(vast, identity=vast["vec"], embedding=vast["components"], dims=2).count()
