"""Operator 11: exact centroid clustering of integer vectors, with lower bounds loosened by planar geometry."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import fs
from millrace.scratch import work_dir

#: Components above this size could overflow a squared distance.
LARGEST = 1 << 26
#: Up to this size products of vectors are exact in doubles, which BLAS adds up.
EXACT = 1 << 20
#: Share by which bounds are widened against rounding.
SLACK = 1e-9
BLOCK_ROWS = 4096
STATE = "vec bigint, components array<bigint>, cluster int, distance bigint, lower double"
#: One row per task and cluster beside the vectors: what the next centroids and spheres are made of.
PARTS = "part int, part_sum array<bigint>, part_rows bigint, part_far bigint, part_inertia bigint, part_scanned bigint"


@dataclass
class Round:
    """Centroids of a round and, per cluster, by how much a lower bound goes down when they take the place of the last ones."""

    centroids: np.ndarray
    loosen: np.ndarray | None = None

    def half_gaps(self) -> np.ndarray:
        """Half the distance of every centroid to the nearest other one: vectors nearer than that need no scan."""
        if len(self.centroids) == 1:
            return np.array([np.inf])
        squares = squared_distances(self.centroids, self.centroids).astype(np.float64)
        np.fill_diagonal(squares, np.inf)
        return np.sqrt(squares.min(axis=1)) / 2 * (1 - SLACK)


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (vectors, centroids) as longs."""
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT:
        products = (vectors.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64)
        return (vectors * vectors).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)[None, :] - 2 * products
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def loosening(before: np.ndarray, after: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Per cluster: how much nearer any other moved centroid can have come to a point of the cluster's sphere.

    A point x is nearer to the moved centroid q than to the old one p by
    ``d cos(a)`` at most, d being the drift and a the angle at the midpoint of
    p and q between q and x: |x-p| + |x-q| is at least twice x's distance to the
    midpoint.  Seen from there the sphere fills a cone, so in the plane of its
    centre, p and q the smallest angle is that of the centre less the cone's
    half angle.  A midpoint inside the sphere leaves the full drift.  If every
    angle is obtuse, the centroid moved away from the whole sphere, and the bound
    rises: there |x-p| + |x-q| is at most twice the distance plus d.
    """
    old, new, radii = before.astype(np.float64), after.astype(np.float64), np.asarray(radii, np.float64) * (1 + SLACK)
    drift = np.sqrt(((new - old) ** 2).sum(axis=1))
    middle = (old + new) / 2
    away = old[:, None, :] - middle[None, :, :]
    gap = np.sqrt((away ** 2).sum(axis=2))
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.clip((away * (new - old)[None, :, :]).sum(axis=2) / (gap * drift[None, :]), -1.0, 1.0)
        half = np.arcsin(np.clip(radii[:, None] / gap, 0.0, 1.0))
    best = np.cos(np.maximum(np.arccos(np.nan_to_num(cosine, nan=1.0)) - np.nan_to_num(half, nan=np.pi), 0.0))
    nearest = np.maximum(gap - radii[:, None], 0.0)
    best = np.where(best < 0, best * 2 * nearest / np.maximum(2 * nearest + drift[None, :], 1e-300), best)
    bound = np.where(radii[:, None] < gap, best, 1.0) * drift[None, :]
    bound = bound + SLACK * (drift[None, :] + gap + radii[:, None])
    bound[:, drift == 0] = 0.0
    np.fill_diagonal(bound, -np.inf)
    return bound.max(axis=1) if len(old) > 1 else np.zeros(1)


def assign(vectors: np.ndarray, cluster: np.ndarray, lower: np.ndarray, now: Round) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, lower bound to every other centroid, scanned rows) by the centroids of ``now``.

    A vector whose own centroid is strictly nearer than the bound of all others
    keeps it; the others, ties among them, are compared with all centroids, of
    which the one with the smallest number wins.  Cluster -1 is not yet known.
    """
    cluster, lower = cluster.copy(), lower.copy()
    known = cluster >= 0
    own = now.centroids[np.maximum(cluster, 0)]
    distance = ((vectors - own) ** 2).sum(axis=1)
    if now.loosen is not None:
        lower[known] -= now.loosen[cluster[known]]
    lower = np.where(known, lower, -1.0)
    safe = known & (np.sqrt(distance.astype(np.float64)) * (1 + SLACK) < np.maximum(lower, now.half_gaps()[np.maximum(cluster, 0)]))
    open_rows = np.flatnonzero(~safe)
    for first in range(0, len(open_rows), BLOCK_ROWS):
        rows = open_rows[first: first + BLOCK_ROWS]
        squares = squared_distances(vectors[rows], now.centroids)
        best = squares.argmin(axis=1)
        cluster[rows], distance[rows] = best, squares[np.arange(len(rows)), best]
        squares[np.arange(len(rows)), best] = np.iinfo(np.int64).max
        second = np.sqrt(squares.min(axis=1).astype(np.float64)) if len(now.centroids) > 1 else np.full(len(rows), np.inf)
        lower[rows] = second * (1 - SLACK)
    return cluster, distance, lower, len(open_rows)


def run_round(state: DataFrame, now: Round) -> DataFrame:
    """The vectors assigned anew and, at the end of every task, its sums by cluster."""
    k, dims = now.centroids.shape
    schema = T._parse_datatype_string(f"{STATE}, {PARTS}")
    types = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64())}
    fields = [pa.field(f.name, types[f.dataType.simpleString()]) for f in schema]

    def lists(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, dims), pa.int32()), pa.array(values.ravel()))

    def batch_of(columns: dict, rows: int) -> pa.RecordBatch:
        arrays = [columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in fields]
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows, far = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        inertia, scanned = np.zeros(k, np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            if np.abs(vectors).max() > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} in size; distances would leave the range of a long")
            cluster, distance, lower, n = assign(vectors, batch.column(2).to_numpy(), batch.column(4).to_numpy(), now)
            scanned += n
            np.add.at(sums, cluster, vectors)
            np.add.at(inertia, cluster, distance)
            np.maximum.at(far, cluster, distance)
            rows += np.bincount(cluster, minlength=k)
            yield batch_of({
                "vec": batch.column(0), "components": batch.column(1), "cluster": pa.array(cluster, pa.int32()),
                "distance": pa.array(distance), "lower": pa.array(lower),
            }, batch.num_rows)
        used = np.flatnonzero(rows)
        if len(used):
            counted = np.zeros(len(used), np.int64)
            counted[0] = scanned
            yield batch_of({
                "part": pa.array(used, pa.int32()), "part_sum": lists(sums[used]), "part_rows": pa.array(rows[used]), "part_far": pa.array(far[used]),
                "part_inertia": pa.array(inertia[used]), "part_scanned": pa.array(counted),
            }, len(used))

    return state.select("vec", "components", "cluster", "distance", "lower").mapInArrow(work, schema)


def part_sums(stored: DataFrame, k: int, dims: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Component sums and counts by cluster: at most ``k`` rows reach the driver."""
    parts = stored.where("part IS NOT NULL").groupBy("part").agg(
        F.array(*[F.sum(F.col("part_sum")[d]) for d in range(dims)]).alias("sums"), F.sum("part_rows").alias("rows"),
        F.max("part_far").alias("far"), F.sum("part_inertia").alias("inertia"), F.sum("part_scanned").alias("scanned"),
    ).collect()
    sums, facts = np.zeros((k, dims), np.int64), {n: np.zeros(k, np.int64) for n in ("rows", "far", "inertia", "scanned")}
    for row in parts:
        sums[row["part"]] = row["sums"]
        for name in facts:
            facts[name][row["part"]] = row[name]
    return sums, facts


def scaled(vectors: DataFrame, identity: Column, embedding: Column, dims: int, scale: int) -> DataFrame:
    """(vec, components) of the vectors of ``dims`` finite components, each floor(scale * x)."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return vectors.where((F.size(embedding) == dims) & finite).select(identity.cast("bigint").alias("vec"), whole.alias("components"))


def cluster_vectors(
    vectors: DataFrame, *, identity: Column, embedding: Column, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2,
    log: list[dict] | None = None,
) -> DataFrame:
    """(vec, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of ``dims`` finite components.

    Components become integers, so every distance, sum and centroid is exact and
    reruns agree.  Centroids start as the ``k`` vectors (all, if fewer) whose ids
    have the smallest SHA-256 of ``seed:id``; null ids come last, and of equal ids
    the smaller vector first.  In each of ``rounds`` rounds vectors go to the nearest
    centroid, ties to the smaller number, and non-empty centroids become the
    floor of their vectors' mean; then vectors are assigned once more.

    Between rounds a vector keeps a lower bound of its distance to all other
    centroids.  :func:`loosening` lowers it by what the cluster's sphere allows,
    and only vectors whose bound no longer decides are scanned.  Each round reads
    the table it stored before, with the vectors in the same task, and exchanges
    only one row of sums per task and cluster; ``k`` rows of ``dims`` sums reach
    the driver.  ``log`` gets per assignment the rows and how many were scanned.

    Null vectors and those with other lengths, null, NaN or infinite components
    are left out; repeated rows and null ids are clustered like any other.
    Components beyond 2^26 after scaling stop the job.  Without vectors the
    result is empty.
    """
    spark = vectors.sparkSession
    kept = scaled(vectors, identity, embedding, dims, scale)
    path = work_dir(spark, "cluster-vectors")
    kept.write.parquet(path)
    kept = spark.read.schema(kept.schema).parquet(path)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec").cast("string")), 256)
    start = kept.orderBy(order.asc_nulls_last(), "components").limit(k).select("components").collect()
    centroids = np.array([r["components"] for r in start], np.int64).reshape(-1, dims)
    state = kept.select("vec", "components", F.lit(-1).alias("cluster"), F.lit(0).cast("bigint").alias("distance"), F.lit(-1.0).alias("lower"))
    if not len(centroids):
        return state.select("vec", "cluster", "distance", F.lit(0).cast("bigint").alias("cluster_inertia"), F.lit(0).cast("bigint").alias("inertia"), F.lit("").alias("centroid_sha256"))
    k, now, paths = len(centroids), Round(centroids), [path]
    for number in range(rounds + 1):
        made = run_round(state, now)
        paths.append(work_dir(spark, "cluster-round"))
        made.write.parquet(paths[-1])
        stored = spark.read.schema(made.schema).parquet(paths[-1])
        fs.delete(spark, paths[-2])  # the new table holds the vectors as well
        state = stored.where("part IS NULL")
        sums, facts = part_sums(stored, k, dims)
        if log is not None:
            log.append({"rows": int(facts["rows"].sum()), "scanned": int(facts["scanned"].sum())})
        if number < rounds:
            moved = np.where(facts["rows"][:, None] > 0, sums // np.maximum(facts["rows"], 1)[:, None], centroids)
            now = Round(moved, loosening(centroids, moved, np.sqrt(facts["far"].astype(np.float64))))
            centroids = moved
    texts = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = int(facts["inertia"].sum())
    named = spark.createDataFrame(
        [(j, int(facts["inertia"][j]), total, texts[j]) for j in range(k)], "_cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return state.join(named, F.col("cluster") == F.col("_cluster")).select(
        "vec", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
