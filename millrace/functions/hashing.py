"""Row hashes and deterministic spreading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tagged(column: str | Column) -> Column:
    """``<length>:<text>``, or ``-`` for null: no two different rows of tagged
    parts give the same text."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(columns: Sequence[str | Column], legacy: bool = False, separator: str = "") -> Column:
    """md5 over the columns in the given order.

    ``legacy`` joins the plain texts and skips nulls, so ('ab','c') and
    ('a','bc') collide when the separator is empty.
    """
    if legacy:
        parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
        return F.md5(F.concat_ws(separator, *parts))
    return F.md5(F.concat_ws(",", *[tagged(c) for c in columns]))


def spread(columns: Sequence[str | Column], slots: Column) -> Column:
    """Slot number in ``[0, slots)`` from the md5 of the columns; the same row
    always lands in the same slot, also when a lost task runs again."""
    digest = F.md5(F.concat_ws(",", *[tagged(c) for c in columns]))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), slots)
