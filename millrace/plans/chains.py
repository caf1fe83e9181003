"""Parent/child chains of type 2 dimensions (header, line, detail)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.cdc import scd2_initial, scd2_merge, unique_rows
from millrace.operators.joins import exclude_quarantined, propagate_parent_id


@dataclass(frozen=True)
class Level:
    """One table of the chain; ``on`` lists (own column, parent column)."""

    name: str
    key: str
    sequence: str
    on: Sequence[tuple[str, str]] = ()
    on_duplicate: str = "fail"
    order_by: Sequence[str] = ()


def scd2_chain(
    levels: Sequence[Level],
    sources: Mapping[str, DataFrame],
    as_of: dt.date,
    targets: Mapping[str, DataFrame] | None = None,
    errors: DataFrame | None = None,
    on_missing: str = "drop",
    legacy_hash: bool = False,
) -> dict[str, DataFrame]:
    """Load the levels in order; each child takes its parent's surrogate.

    A level without target is loaded for the first time.  Quarantined keys leave
    the source first.  The rows of a level are stored while they are numbered or
    compared, so the next level and the caller read that and not the source again.
    A later run takes the parent's surrogate for new keys alone where the latest
    row of a key is kept: all other rows have theirs.
    """
    done: dict[str, DataFrame] = {}
    parent: Level | None = None
    for level in levels:
        source = sources[level.name]
        if errors is not None:
            source = exclude_quarantined(source, errors, level.name, level.key)
        parent_id = parent.sequence if parent else None
        target = (targets or {}).get(level.name)
        resolve = None
        if parent_id:
            given = parent_id in source.columns
            if not given:
                source = source.withColumn(parent_id, F.lit(None).cast("bigint"))
            # copies of a row collapse below, by key
            if target is None or given or level.on_duplicate != "latest":
                source = propagate_parent_id(source, done[parent.name], level.on, parent_id, distinct=False)
            else:
                # of several parents the last one counts, as it would among copies of the row
                found = done[parent.name].groupBy(*dict.fromkeys(p for _, p in level.on)).agg(F.max(parent_id).alias(parent_id))
                resolve = partial(propagate_parent_id, parent=found, on=level.on, parent_id=parent_id, distinct=False)
        if target is None:
            # ranges of the key serve both the choice and the numbers
            clean = unique_rows(source.repartitionByRange(level.key), level.key, level.on_duplicate, level.order_by)
            result = scd2_initial(clean, level.key, level.sequence, as_of, one_per_key=True, ranged=True)
        else:
            result = scd2_merge(
                target, source, level.key, level.sequence, as_of, on_missing, parent_id,
                on_duplicate=level.on_duplicate, order_by=level.order_by, legacy_hash=legacy_hash, resolve=resolve,
            )
        done[level.name] = result
        parent = level
    return done
