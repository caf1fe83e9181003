"""Stored tables of which a change rewrites only the files that hold a changed key.

Below the table's folder lie data files, which never change, one manifest per
version (a Parquet table of file names, row counts and key ranges) and one small
pointer file per version.  A version exists once its pointer does; readers take the
files of the newest one.  A run that stops before that leaves files that no version
names, and the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import fs
from millrace.functions.columns import match_keys, names
from millrace.operators import cdc

#: Ranges into which the keys of a change are gathered to choose candidate files.
RANGES = 256


class ConflictError(RuntimeError):
    """Another run stored a version in the meantime."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    manifest: str
    keys: tuple[str, ...]
    schema: T.StructType

    def files(self, spark: SparkSession) -> DataFrame:
        """(file, rows, nulls, low, high): low and high bound the first key column, nulls counts its nulls."""
        return spark.read.schema(manifest_schema(self.schema, self.keys)).parquet(f"{self.folder}/manifest/{self.manifest}")


def manifest_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    kind, long = schema[keys[0]].dataType, T.LongType()
    return T.StructType([
        T.StructField("file", T.StringType()), T.StructField("rows", long), T.StructField("nulls", long),
        T.StructField("low", kind), T.StructField("high", kind),
    ])


def numbers(spark: SparkSession, path: str) -> list[int]:
    listed = fs.children(spark, f"{path.rstrip('/')}/versions")
    return sorted(int(n[:-5]) for n in listed if n.endswith(".json") and n[:-5].isdigit())


def find_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version, or the one with that number; None if there is none."""
    folder = path.rstrip("/")
    for n in reversed(numbers(spark, path)) if number is None else [number]:
        text = fs.read(spark, f"{folder}/versions/{n:020d}.json")
        if text.endswith(b"}"):  # a pointer that a crash left unfinished is no version
            known = json.loads(text)
            return Version(n, folder, known["manifest"], tuple(known["keys"]), T.StructType.fromJson(known["schema"]))
    return None


def read_files(spark: SparkSession, version: Version, files: Sequence[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*[f"{version.folder}/data/{f}" for f in files])


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The rows of the newest version, or of that number; None before the first one."""
    version = find_version(spark, path, number)
    if version is None:
        return None
    return read_files(spark, version, [r["file"] for r in version.files(spark).select("file").collect()])


def file_name() -> Column:
    """Folder and name of a row's data file, as manifests hold it."""
    return F.array_join(F.slice(F.split(F.col("_metadata.file_path"), "/"), -2, 2), "/")


def write_files(df: DataFrame, folder: str, keys: Sequence[str], files: int | None) -> DataFrame:
    """New data files in ranges of the keys; their rows of the manifest, from a scan of the first key column."""
    name = uuid.uuid4().hex
    dealt = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).write.parquet(f"{folder}/data/{name}")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/data/{name}")
    key = F.col(f"`{keys[0]}`")
    return written.select(key.alias("key"), file_name().alias("file")).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("key").isNull()).alias("nulls"), F.min("key").alias("low"), F.max("key").alias("high")
    )


def commit(spark: SparkSession, folder: str, base: Version | None, manifest: DataFrame, keys: Sequence[str], schema: T.StructType) -> Version:
    """Store the manifest, then the pointer, whose name only one run can take."""
    name = uuid.uuid4().hex
    rows = manifest.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in manifest_schema(schema, keys)])
    rows.coalesce(max(1, min(16, rows.rdd.getNumPartitions()))).write.parquet(f"{folder}/manifest/{name}")
    newest = find_version(spark, folder)
    if (newest.number if newest else None) != (base.number if base else None):
        raise ConflictError(f"{folder}: version {newest.number} was stored meanwhile")
    number = max(numbers(spark, folder), default=0) + 1
    text = json.dumps({"manifest": name, "keys": list(keys), "schema": schema.jsonValue(), "base": base.number if base else None})
    if not fs.create(spark, f"{folder}/versions/{number:020d}.json", text.encode()):
        raise ConflictError(f"{folder}: version {number} was stored meanwhile")
    return Version(number, folder, name, tuple(keys), schema)


def write_version(df: DataFrame, path: str, keys: str | Sequence[str], files: int | None = None) -> Version:
    """Store ``df`` as a new version of its own, in files of key ranges; older versions stay until ``clean_versions``."""
    spark, keys, folder = df.sparkSession, names(keys), path.rstrip("/")
    base = find_version(spark, folder)
    return commit(spark, folder, base, write_files(df, folder, keys, files), keys, df.schema)


def candidate_files(spark: SparkSession, version: Version, changed: DataFrame) -> list[str]:
    """Files whose range of the first key column meets a range of the changed keys, or both hold nulls."""
    key = changed.columns[0]
    ranged = changed.select(F.col(f"`{key}`").alias("key")).repartitionByRange(RANGES, "key")
    met = ranged.groupBy(F.spark_partition_id().alias("part")).agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.count_if(F.col("key").isNull()).alias("nulls")
    ).collect()
    kind = version.schema[version.keys[0]].dataType
    test = F.lit(any(r["nulls"] for r in met)) & (F.col("nulls") > 0)
    for r in met:
        if r["low"] is not None:
            test = test | ((F.col("low") <= F.lit(r["high"]).cast(kind)) & (F.col("high") >= F.lit(r["low"]).cast(kind)))
    return [r["file"] for r in version.files(spark).where(test).select("file").collect()]


def touched_files(spark: SparkSession, version: Version, changed: DataFrame) -> list[str]:
    """Files that hold a changed key; only the key columns of candidates are read."""
    candidates = candidate_files(spark, version, changed)
    if not candidates:
        return []
    keys = list(version.keys)
    held = read_files(spark, version, candidates).select(*keys, file_name().alias("_file"))
    return [r["_file"] for r in match_keys(held, changed, keys, "left_semi").select("_file").distinct().collect()]


def change_version(
    spark: SparkSession, path: str, changed: DataFrame, apply: Callable[[DataFrame], DataFrame], files: int | None = None
) -> Version:
    """A new version in which ``apply`` has changed the rows of the files that hold a key of ``changed``.

    ``changed`` has the table's key columns; null keys match null keys.  ``apply``
    gets the rows of those files and returns what takes their place, new rows
    included.  All other files go on under their names.  New files are as many
    as those they replace (one at least), or ``files``.
    """
    base = find_version(spark, path)
    if base is None:
        raise FileNotFoundError(f"{path} has no version yet")
    touched = touched_files(spark, base, changed.select(*base.keys).distinct())
    rows = apply(read_files(spark, base, touched)).select(*base.schema.names)
    new = write_files(rows, base.folder, base.keys, files or max(1, len(touched)))
    gone = spark.createDataFrame([(f,) for f in touched], "file string")
    manifest = base.files(spark).join(gone, "file", "left_anti").unionByName(new)
    return commit(spark, base.folder, base, manifest, base.keys, base.schema)


def merge_version(spark: SparkSession, path: str, changes: DataFrame, op_column: str, helper: str = "rno", files: int | None = None) -> Version:
    """INS, UPD and DEL rows applied, as ``cdc.merge_by_indicator`` does."""
    base = find_version(spark, path)
    marked = changes.filter(F.col(op_column).isNotNull())
    return change_version(spark, path, marked, lambda rows: cdc.merge_by_indicator(rows, changes, base.keys, op_column, helper), files)


def upsert_version(spark: SparkSession, path: str, changes: DataFrame, files: int | None = None) -> Version:
    """Incoming rows take the place of stored ones with the same key."""
    base = find_version(spark, path)
    return change_version(spark, path, changes, lambda rows: cdc.upsert(rows, changes, base.keys), files)


def append_version(df: DataFrame, path: str, files: int | None = None) -> Version:
    """New rows in files of their own; no stored file is read."""
    spark, base = df.sparkSession, find_version(df.sparkSession, path)
    if base is None:
        raise FileNotFoundError(f"{path} has no version yet")
    new = write_files(df.select(*base.schema.names), base.folder, base.keys, files)
    return commit(spark, base.folder, base, base.files(spark).unionByName(new), base.keys, base.schema)


def clean_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove all but the newest ``keep`` versions and the files that none of these names; the removed files.

    Not to be run while another run writes: its files have no version yet.
    """
    folder, known = path.rstrip("/"), numbers(spark, path)
    kept = [v for v in (find_version(spark, path, n) for n in known) if v][-keep:]
    used = {r["file"] for v in kept for r in v.files(spark).select("file").collect()}
    for n in known:
        if n not in {v.number for v in kept}:
            fs.delete(spark, f"{folder}/versions/{n:020d}.json")
    for name in fs.children(spark, f"{folder}/manifest"):
        if name not in {v.manifest for v in kept}:
            fs.delete(spark, f"{folder}/manifest/{name}")
    removed = []
    for written in fs.children(spark, f"{folder}/data"):
        inside = [f for f in fs.children(spark, f"{folder}/data/{written}") if not f.startswith(("_", "."))]
        gone = [f for f in inside if f"{written}/{f}" not in used]
        for f in gone if len(gone) < len(inside) else [""]:
            fs.delete(spark, f"{folder}/data/{written}/{f}".rstrip("/"))
        removed += [f"{written}/{f}" for f in gone]
    return removed
