"""Small Column builders."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def names(columns: str | Iterable[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def null_safe(left: str, right: str, keys: Sequence[str], right_keys: Sequence[str] | None = None) -> Column:
    """``l.k <=> r.k AND …`` for two aliased frames; nulls match nulls."""
    pairs = zip(keys, right_keys or keys)
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{r}`")) for k, r in pairs],
    )


def match_keys(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    how: str,
    right_keys: str | Sequence[str] | None = None,
    nulls_match: bool = True,
) -> DataFrame:
    """Join on null-safe equality and keep the left columns (semi, anti) or
    the left columns plus the right non-key columns (inner, left).

    The right side is usually an aggregate by the same keys.  Null-safe keys are
    exchanged once more after that (small) aggregate, and only a side that comes
    straight from such an exchange lets adaptive execution split a hot key of
    the left side over several tasks.  With ``nulls_match`` off the right nulls
    are dropped first, which gives plain equality.
    """
    keys = names(keys)
    right_keys = keys if right_keys is None else names(right_keys)
    if not nulls_match:
        right = right.dropna(subset=right_keys)
    joined = left.alias("l").join(right.alias("r"), null_safe("l", "r", keys, right_keys), how)
    if how in ("left_semi", "left_anti"):
        return joined
    kept = [F.col(f"l.`{c}`") for c in left.columns]
    return joined.select(*kept, *[F.col(f"r.`{c}`") for c in right.columns if c not in right_keys])
