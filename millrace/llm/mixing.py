"""Operator 1: mix sources to target weights under a cap on epochs (capped water-filling)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import packed, unpacked
from millrace.scratch import stage

OUTPUTS = ("size", "source_size", "target", "repeats")
#: Hex digits of the sampling hash that name a bucket of a source.
BUCKET_DIGITS = 4


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``.

    Every source gets its weighted part of ``total``; parts above
    ``max_epochs`` times the source's size are clamped there and the excess is
    shared by weight among the others, until none is above.  Only sums cross the
    driver.  If the caps together are below ``total``, every target is its cap.
    Null or negative weights count as 0.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    weight = F.greatest(F.coalesce(F.col("weight"), F.lit(0)), F.lit(0)).cast("double")
    level, clamped = 0.0, -1
    while True:
        full = cap <= weight * F.lit(level)
        row = sources.agg(
            F.count(F.when(full, 1)).alias("n"),
            F.sum(F.when(full, cap)).alias("held"),
            F.sum(F.when(~full, weight)).alias("weight"),
        ).first()
        if row["n"] == clamped or not row["weight"]:
            break
        clamped, level = row["n"], (total - (row["held"] or 0.0)) / row["weight"]
    target = F.when(cap <= weight * F.lit(level), cap).otherwise(weight * F.lit(level))
    return sources.withColumn("target", target.cast("double"))


def sampling_hash(identity: Column, seed: int) -> Column:
    """Seeded hash in hex; null hashes like the text ``null``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("null"))))


def plan_mix(sized: DataFrame, weights: DataFrame, total: float | None, max_epochs: float) -> DataFrame:
    """One row per source: size, target, whole repetitions and the hash up to which one more is due.

    ``sized`` has source, size and hash.  Within a source the rows are taken in
    hash order until the sum of their sizes comes nearest to the words that whole
    repetitions leave open.  The sums run over buckets of the hash first, then
    over the one bucket in which the bound lies.
    """
    bucket = F.substring("hash", 1, BUCKET_DIGITS)
    parts = stage(sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size")), "mix-parts")
    sources = parts.groupBy("source").agg(F.sum("size").alias("source_size"))
    known = weights.groupBy(F.col("source").alias("_source")).agg(F.sum("weight").alias("weight"))
    sources = sources.join(known, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    sources = stage(sources, "mix-sources")
    if total is None:
        total = sources.agg(F.sum("source_size")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    filled = (
        water_fill(sources, total, max_epochs)
        .withColumn("whole", F.floor(ratio))
        .withColumn("open", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    )
    filled = stage(filled.drop("weight"), "mix-filled")

    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    wanted = filled.select(F.col("source").alias("_source"), "open")
    edge = (
        parts.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .join(wanted, F.col("source").eqNullSafe(F.col("_source")))
        .where((F.col("open") > 0) & (F.col("before") < F.col("open")) & (F.col("open") <= F.col("before") + F.col("size")))
        .select("_source", F.col("bucket").alias("_bucket"), "before", "open")
    )
    # stored: one row per source, whose size decides how it is joined
    edge = stage(edge, "mix-edges")
    inside = sized.join(edge, F.col("source").eqNullSafe(F.col("_source")) & (bucket == F.col("_bucket")))
    inside = inside.groupBy("_source", "_bucket", "before", "open", "hash").agg(F.sum("size").alias("size"))
    running = Window.partitionBy("_source").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("size").over(running), F.lit(0)) + F.col("size") / 2
    # the bucket's own digits sort before every hash in it: all rows of earlier buckets, none of this one
    limits = (
        inside.select("_source", "_bucket", F.when(middle < F.col("open"), F.col("hash")).alias("hash"))
        .groupBy("_source")
        .agg(F.coalesce(F.max("hash"), F.min("_bucket")).alias("limit"))
    )
    # stored, so that the join to the documents knows its size
    return stage(filled.join(limits, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source", "open"), "mix-plan")


def mix_sources(
    docs: DataFrame, weights: DataFrame | None, *, size: Column, identity: Column, source: Column,
    max_epochs: float = 3.0, total: float | None = None, seed: int = 17,
) -> DataFrame:
    """``docs`` with size, source_size, target and repeats (how often the mix takes the row).

    ``weights`` holds (source, weight), null being a source of its own; None
    gives the sources, by code point with null last, the weights 1, 2, 3 in
    turn.  ``total`` is the size of the mix, by default that of all rows.
    ``identity`` feeds the sampling hash: repeated rows share their fate, and
    reruns agree whatever the layout.  Null or absent sizes count as 0; a source
    without size has the target 0 and no repeats.  Columns named like an output
    are replaced.  An empty table gives an empty one.

    The texts are read twice and never shuffled while the table of sources is
    small enough for the session's broadcast limit.
    """
    known = docs.select(
        packed(docs), source.alias("source"), F.coalesce(size, F.lit(0)).cast("bigint").alias("size"),
        sampling_hash(identity, seed).alias("hash"),
    )
    sized = stage(known.drop("row"), "mix-sizes")
    if weights is None:
        weights = turn_weights(sized)
    plan = plan_mix(sized, weights, total, max_epochs).withColumnRenamed("source", "_source")
    extra = (F.col("hash") <= F.col("limit")).cast("bigint")
    joined = known.join(plan, F.col("source").eqNullSafe(F.col("_source")), "left")
    return joined.select(
        *unpacked(docs.columns, OUTPUTS), "size", "source_size", "target",
        (F.col("whole") + F.coalesce(extra, F.lit(0))).cast("bigint").alias("repeats"),
    )


def turn_weights(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, weight): ``weights`` in turn over the sources by code point, null last.

    Ranks come from staged range buckets, so that the sources need not meet in one task.
    """
    ranged = sized.select("source").distinct().repartitionByRange(F.col("source").asc_nulls_last())
    ranged = stage(ranged.select("source", F.spark_partition_id().alias("bucket")), "mix-order")
    sizes = ranged.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(F.col("bucket").alias("_bucket"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.col("source").asc_nulls_last()))
    place = (F.col("rank") + F.col("shift") - 1) % len(weights)
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int"))
    numbered = ranged.withColumn("rank", rank).join(shifts, F.col("bucket") == F.col("_bucket"))
    return numbered.select("source", turn.alias("weight"))


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken, without the operator's columns.

    Columns of the input that are named like those were replaced by ``mix_sources``;
    pack them into one before, where they must come back.
    """
    columns = [F.col(f"`{c}`") for c in mixed.columns if c not in OUTPUTS]
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("repeats")))
    return mixed.where(F.col("repeats") > 0).select(F.struct(*columns).alias("row"), copies.alias("copy")).select("row.*")
