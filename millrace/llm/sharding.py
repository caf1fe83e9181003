"""Operator 5: uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import packed, unpacked
from millrace.scratch import stage

OUTPUTS = ("shard", "slot")
#: numpy draws exactly below this population; above it the inversion below is used.
NUMPY_LIMIT = 10**9


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` drawn without replacement are good."""
    low, high = max(0, sample - bad), min(sample, good)
    if low == high:
        return low
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, sample))
    # inversion around the mode: probabilities from their ratios, as far as they matter
    mode = min(max((sample + 1) * (good + 1) // (good + bad + 2), low), high)
    share = good / (good + bad)
    reach = int(40 * math.sqrt(sample * share * (1 - share) + 1)) + 50
    up = np.arange(mode, min(high, mode + reach), dtype=np.float64)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    more = np.cumsum(np.log((good - up) * (sample - up)) - np.log((up + 1) * (bad - sample + up + 1)))
    less = np.cumsum(np.log(down * (bad - sample + down)) - np.log((good - down + 1) * (sample - down + 1)))
    weights = np.exp(np.concatenate([less[::-1], [0.0], more]))
    chosen = int(np.searchsorted(np.cumsum(weights), rng.random() * weights.sum(), side="right"))
    return mode - len(less) + min(chosen, len(weights) - 1)


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows each partition sends to each shard, drawn as a uniform shuffle would; rows and columns add up exactly."""
    rng = np.random.Generator(np.random.PCG64(seed))
    room, matrix = list(sizes), []
    for count in counts:
        left, others, line = count, sum(room), []
        for place in room:
            others -= place
            taken = draw_hypergeometric(rng, place, others, left)
            line.append(taken)
            left -= taken
        room = [r - t for r, t in zip(room, line)]
        matrix.append(line)
    return matrix


def shard_rows(docs: DataFrame, shards: int, *, seed: int = 29, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """``docs`` with shard (0 to ``shards`` - 1) and slot (gapless from 0 in each shard).

    Shard sizes differ by one at most (the first ones are larger) and every
    assignment is equally likely.  The staged input's partitions are counted;
    the driver draws how many rows each sends to each shard (one line of
    ``shards`` numbers per partition); every partition is permuted by a seeded
    hash and cut at those counts; within the shard the rows are permuted again,
    in buckets of about ``rows_per_bucket`` rows so that no shard meets in one
    task.  Nulls and repeated rows are rows like any other.  An empty table
    gives an empty one.  Columns named like an output are replaced.

    Only partition, position and numbers travel through the draws; the rows
    themselves are staged once and exchanged once.
    """
    spark = docs.sparkSession
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stage(docs.select(packed(docs), F.spark_partition_id().alias("part"), position.alias("at")), "shard-rows")
    counts = sorted((r["part"], r["count"]) for r in rows.groupBy("part").count().collect())
    total = sum(n for _, n in counts)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    cuts = [(part, np.cumsum(line).tolist()) for (part, _), line in zip(counts, matrix)]
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("cuts", T.ArrayType(T.LongType()))])
    sent = spark.createDataFrame(cuts, schema)

    keyed = rows.select("part", "at", F.xxhash64(F.lit(seed), "part", "at").alias("first"))
    local = F.row_number().over(Window.partitionBy("part").orderBy("first", "at")) - 1
    routed = keyed.withColumn("rank", local).join(sent, F.col("part") == F.col("_part"))
    shard = F.size(F.filter("cuts", lambda c: c <= F.col("rank"))).cast("int")
    buckets = max(1, math.ceil(total / shards / rows_per_bucket))
    second = F.xxhash64(F.lit(seed + 1), "part", "at")
    placed = stage(
        routed.select("part", "at", shard.alias("shard"), second.alias("second")).withColumn(
            "bucket", F.pmod(F.shiftrightunsigned("second", 8), F.lit(buckets))
        ),
        "shard-places",
    )
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    shifts = shifts.select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("second", "part", "at")) - 1
    slots = placed.withColumn("inside", inside).join(shifts, ["shard", "bucket"])
    slots = slots.select("part", "at", "shard", (F.col("inside") + F.col("shift")).cast("bigint").alias("slot"))
    return rows.join(slots, ["part", "at"]).select(*unpacked(docs.columns, OUTPUTS), "shard", "slot")
