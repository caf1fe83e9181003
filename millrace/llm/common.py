"""What several operators share: word rules, packed rows and files in the shared folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    """Runs of other than ASCII white space; null has none.

    Each word with the white space around it shrinks to one character, so no
    array of words is built.  The appended word keeps white space from the end.
    """
    shrunk = F.regexp_replace(F.concat(text, F.lit(" x")), f"[{SPACE}]*+[^{SPACE}]++[{SPACE}]*+", "x")
    return F.coalesce(F.length(shrunk) - 1, F.lit(0)).cast("bigint")


def packed(df: DataFrame) -> Column:
    """The whole row as one column, so that added names cannot clash with its own."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")


def unpacked(columns: Sequence[str], outputs: Sequence[str]) -> list[Column]:
    """The columns of a packed row, without those that ``outputs`` replaces."""
    taken = {c.lower() for c in outputs}
    return [F.col("row").getField(c).alias(c) for c in columns if c.lower() not in taken]


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder in the shared store, as tasks reach it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    scheme, _, rest = uri.partition("://")
    # Hadoop's names of a store that Arrow knows under another one
    return pafs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme) }://{rest}")


class TaskFile:
    """A file that one task attempt writes; its name is its own, so attempts never meet.

    Only files named in a stored manifest count: those of lost or repeated
    attempts are never read.
    """

    def __init__(self, folder: str, suffix: str):
        self.files, root = open_folder(folder)
        self.files.create_dir(root, recursive=True)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self.stream = self.files.open_output_stream(os.path.join(root, self.name), compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; the offset at which ``data`` starts."""
        at = self.size
        self.stream.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self.stream.close()
