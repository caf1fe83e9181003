"""Change capture as a stream.

An addition to the batch operators: instead of polling by last success time,
the checkpoint remembers what was read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace import fs
from millrace.functions.columns import names
from millrace.functions.hashing import spread
from millrace.operators.cdc import merge_by_indicator, upsert
from millrace.operators.runlog import latest_runs

BUCKET = "_bucket"
# marks the one row without data that keeps an emptied bucket on disk
BLANK = "_blank"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, spread(keys, F.lit(buckets)).cast("int"))


def write_bucketed(df: DataFrame, path: str, keys: str | Sequence[str], buckets: int) -> None:
    """First load of a stream target: Parquet in one folder per key bucket."""
    rows = with_bucket(df, names(keys), buckets).withColumn(BLANK, F.lit(False))
    # rebalancing merges small and splits large buckets into even files
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("overwrite").parquet(path)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    marks = [T.StructField(BLANK, T.BooleanType()), T.StructField(BUCKET, T.IntegerType())]
    rows = spark.read.schema(T.StructType([*schema.fields, *marks])).parquet(path)
    return rows.filter(~F.col(BLANK)).select(*schema.names, BUCKET)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a stream target."""
    return _stored(spark, path, schema).drop(BUCKET)


def _replace_buckets(spark: SparkSession, staged: str, path: str) -> None:
    (
        spark.read.parquet(staged)
        .hint("rebalance", BUCKET)
        .write.option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .mode("overwrite")
        .parquet(path)
    )


def apply_batch(
    batch: DataFrame,
    epoch: int,
    path: str,
    staging: str,
    keys: str | Sequence[str],
    schema: T.StructType,
    buckets: int,
    op_column: str | None = None,
    order_by: str | Sequence[str] = (),
) -> None:
    """Merge one micro-batch; only the key buckets it touches are rewritten.

    The merged buckets are stored under the epoch first.  When the same epoch is
    delivered again, a completed copy is reused, so a crash during the final
    write loses nothing.  A bucket left without rows keeps an empty file.  Copies
    of earlier epochs go: a new epoch begins only after they were committed.
    """
    spark = batch.sparkSession
    keys = names(keys)
    for name in fs.children(spark, staging):
        if name.startswith("epoch=") and int(name[len("epoch="):]) < epoch:
            fs.delete(spark, f"{staging.rstrip('/')}/{name}")
    staged = f"{staging.rstrip('/')}/epoch={epoch}"
    if not fs.committed(spark, staged):
        if batch.isEmpty():
            return
        changes = latest_runs(batch, keys, order_by) if order_by else batch
        changes = with_bucket(changes, keys, buckets).persist()
        # at most ``buckets`` numbers
        touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]
        stored = _stored(spark, path, schema)
        current = stored.filter(F.col(BUCKET).isin(touched))
        if op_column:
            merged = merge_by_indicator(current, changes, keys, op_column)
        else:
            merged = upsert(current, changes, keys)
        # one blank row per touched bucket, so that an emptied bucket is rewritten too
        marks = spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int")
        blank = marks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], BUCKET)
        rows = merged.select(*schema.names, BUCKET).withColumn(BLANK, F.lit(False))
        rows.unionByName(blank.withColumn(BLANK, F.lit(True))).write.mode("overwrite").parquet(staged)
        changes.unpersist()
    _replace_buckets(spark, staged, path)


def apply_changes(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    keys: str | Sequence[str],
    schema: T.StructType,
    buckets: int,
    op_column: str | None = None,
    order_by: str | Sequence[str] = (),
) -> StreamingQuery:
    """Run a change stream into a bucketed target until its input is used up."""
    staging = f"{checkpoint.rstrip('/')}-merged"

    def step(batch: DataFrame, epoch: int) -> None:
        apply_batch(batch, epoch, path, staging, keys, schema, buckets, op_column, order_by)

    return (
        changes.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drop_repeats(stream: DataFrame, time: str, keys: str | Sequence[str], delay: str) -> DataFrame:
    """Drop rows delivered twice at inclusive window edges, by key within the
    watermark's delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(names(keys))
