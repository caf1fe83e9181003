"""Shared working folder for staged tables.

Staging writes a frame as Parquet below the folder the cluster names in
``spark.checkpoint.dir`` and reads it back.  It cuts lineage, fixes values that
depend on the physical layout (partition ids) and survives a lost executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from millrace import fs

_SCOPE: ContextVar[str] = ContextVar("millrace_scope", default="")

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, named with its file system; a local session without one gets its own."""
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{SETTING} must name a folder that all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        root = spark.sparkContext.getCheckpointDir()
    return fs.qualified(spark, root).rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call returns."""
    scope = _SCOPE.get()
    return f"{shared_root(spark)}/millrace/{scope}{label}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove everything staged inside when the block ends.

    Results have to be written before that: frames built inside read the staged
    tables.  Blocks may be nested; each removes its own.
    """
    scope = f"{_SCOPE.get()}scope-{uuid.uuid4().hex}/"
    token = _SCOPE.set(scope)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        fs.delete(spark, f"{shared_root(spark)}/millrace/{scope}")


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder once and return the stored table; ``options`` are the writer's."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
