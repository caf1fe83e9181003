"""File listing through the Hadoop file system that Spark itself uses."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the store that Spark resolves it against: readers outside Spark then find the same place."""
    jpath, files = _open(spark, path)
    return files.makeQualified(jpath).toString()


def exists(spark: SparkSession, path: str) -> bool:
    jpath, files = _open(spark, path)
    return files.exists(jpath)


def committed(spark: SparkSession, path: str) -> bool:
    """True once a Spark write to ``path`` finished its job commit."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def release(spark: SparkSession, path: str) -> None:
    """Take the mark of a finished write away."""
    delete(spark, f"{path.rstrip('/')}/_SUCCESS")


def has_data(spark: SparkSession, path: str) -> bool:
    """True when the folder (or file) holds anything but hidden entries."""
    jpath, files = _open(spark, path)
    if not files.exists(jpath):
        return False
    if not files.getFileStatus(jpath).isDirectory():
        return True
    return any(not name.startswith(("_", ".")) for name in children(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    jpath, files = _open(spark, path)
    if not files.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(jpath))


def delete(spark: SparkSession, path: str) -> None:
    jpath, files = _open(spark, path)
    files.delete(jpath, True)


def first_file(spark: SparkSession, path: str) -> str:
    """``path`` itself, or the first visible file of the folder or glob."""
    jpath, files = _open(spark, path)
    for status in files.globStatus(jpath) or []:
        if not status.isDirectory():
            return status.getPath().toString()
        inside = status.getPath().toString()
        for name in children(spark, inside):
            if not name.startswith(("_", ".")):
                return f"{inside}/{name}"
    raise FileNotFoundError(path)


def files(spark: SparkSession, path: str) -> list[str]:
    """All visible files of a path, folder or glob."""
    jpath, store = _open(spark, path)
    found, todo = [], list(store.globStatus(jpath) or [])
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += [s for s in store.listStatus(status.getPath()) if not s.getPath().getName().startswith(("_", "."))]
        else:
            found.append(status.getPath().toString())
    return sorted(found)


def head(spark: SparkSession, path: str, size: int) -> bytes:
    """First ``size`` bytes of one file."""
    jpath, files = _open(spark, first_file(spark, path))
    stream = files.open(jpath)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def create(spark: SparkSession, path: str, data: bytes) -> bool:
    """Write a small new file; False when there is one of that name already."""
    jpath, files = _open(spark, path)
    try:
        stream = files.create(jpath, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or files.exists(jpath):
            return False
        raise
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    return True


def read(spark: SparkSession, path: str) -> bytes:
    """The whole of one small file."""
    jpath, files = _open(spark, path)
    stream = files.open(jpath)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()
