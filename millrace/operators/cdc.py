"""Change data capture: merges, slowly changing dimensions, hash satellites."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import match_keys, names
from millrace.functions.constants import INSERTS, OPEN_END, UPDATES
from millrace.functions.hashing import row_hash
from millrace.operators.columns import evolve_to
from millrace.operators.sets import complement
from millrace.operators.windows import assign_sequence, number_rows, placed, shifted


def unique_rows(
    df: DataFrame, keys: str | Sequence[str], on_duplicate: str = "fail", order_by: str | Sequence[str] = ()
) -> DataFrame:
    """One row per non-null key.

    Identical copies collapse.  When the rows of a key differ, ``fail`` stops the
    job and ``latest`` keeps the last one in ``order_by``.  A null key always
    stops the job.  Done as an aggregate, so repeated keys shrink inside each
    task; the result is partitioned by key and a following join on it needs no
    further exchange.
    """
    if on_duplicate not in ("fail", "latest"):
        raise ValueError("on_duplicate must be 'fail' or 'latest'")
    keys = names(keys)
    first = [c for c in names(order_by) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    row = F.struct(*first, *rest)
    ends = [F.max(row).alias("_row")]
    if on_duplicate == "fail":
        ends.append(F.min(row).alias("_other"))
    found = df.groupBy(*keys).agg(*ends)
    bad_null = F.lit(False)
    for k in keys:
        bad_null = bad_null | F.col(f"`{k}`").isNull()
    chosen = F.when(bad_null, F.raise_error(F.lit(f"null in key {keys}")))
    if on_duplicate == "fail":
        differs = ~F.col("_row").eqNullSafe(F.col("_other"))
        chosen = chosen.when(differs, F.raise_error(F.lit(f"key {keys} has different rows")))
    found = found.select(*keys, chosen.otherwise(F.col("_row")).alias("_row"))
    return found.select(*[c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def merge_by_indicator(
    target: DataFrame, changes: DataFrame, keys: str | Sequence[str], op_column: str, helper: str = "rno"
) -> DataFrame:
    """Apply INS, UPD and DEL rows.

    Target rows whose key has a change row go away, INS and UPD rows come in;
    the indicator and the helper column are dropped.  Rows without an indicator
    are no change.
    """
    keys = names(keys)
    marked = changes.filter(F.col(op_column).isNotNull())
    kept = match_keys(target, marked.select(*keys).distinct(), keys, "left_anti")
    fresh = marked.filter(F.col(op_column).isin(*INSERTS, *UPDATES)).drop(op_column, helper)
    return kept.unionByName(fresh)


def upsert(target: DataFrame, changes: DataFrame, keys: str | Sequence[str], mode: str = "replace") -> DataFrame:
    """Keyed upsert without indicator.

    ``replace``: incoming rows take the place of target rows with the same key.
    ``keep_versions``: only target rows equal to an incoming matched row go
    away (and the remaining ones become distinct), so older versions survive.
    """
    keys = names(keys)
    if mode == "replace":
        return match_keys(target, changes.select(*keys).distinct(), keys, "left_anti").unionByName(changes)
    if mode != "keep_versions":
        raise ValueError("mode must be 'replace' or 'keep_versions'")
    stored = target.select(*keys).distinct()
    matched = match_keys(changes, stored, keys, "left_semi", nulls_match=False).select(*target.columns)
    return complement(target, matched).unionByName(changes)


def append(target: DataFrame, changes: DataFrame) -> DataFrame:
    return changes.unionByName(target)


def partition_snapshot(target: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The increment alone; the sink writes it to its own date partition."""
    return changes


def first_load(changes: DataFrame) -> DataFrame:
    return changes


def replace_stamped(
    target: DataFrame | None,
    changes: DataFrame,
    keys: str | Sequence[str],
    as_of: dt.datetime,
    stamp: str = "etl_insert_ts",
) -> DataFrame:
    """Replace by key and stamp every row with the load time."""
    merged = changes if target is None else upsert(target.drop(stamp), changes, keys)
    return merged.withColumn(stamp, F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"))


def scd2_initial(
    source: DataFrame,
    key: str | Sequence[str],
    sequence: str,
    as_of: dt.date,
    start: str = "start_dt",
    end: str = "end_dt",
    open_end: dt.date = OPEN_END,
    one_per_key: bool = False,
    ranged: bool = False,
) -> DataFrame:
    """First load of a type 2 dimension: numbered rows, all open.

    ``one_per_key`` says that no key repeats: the rows are numbered as they are,
    without a join back from the distinct keys; ``ranged`` that they also come
    range partitioned by key.
    """
    rows = source.drop(sequence)
    numbered = number_rows(rows, key, sequence, ranged=ranged) if one_per_key else assign_sequence(rows, key, sequence)
    return numbered.withColumns({start: F.lit(as_of), end: F.lit(open_end)})


def _with_hash(df: DataFrame, columns: Sequence[str], name: str, legacy: bool) -> DataFrame:
    return df.withColumn(name, row_hash(list(columns), legacy=legacy))


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    sequence: str,
    as_of: dt.date,
    on_missing: str = "drop",
    parent_id: str | None = None,
    skip: Sequence[str] = (),
    on_duplicate: str = "fail",
    order_by: str | Sequence[str] = (),
    start: str = "start_dt",
    end: str = "end_dt",
    open_end: dt.date = OPEN_END,
    legacy_hash: bool = False,
    resolve: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One run of a type 2 dimension against a full source snapshot.

    New keys get the next sequence numbers; a changed row closes the open
    version (the day before ``as_of``, or ``as_of`` itself when it was opened
    that day) and opens a new one with the same number and parent id; equal
    rows and history stay.  Open rows whose key left the source are dropped,
    kept or closed as ``on_missing`` says.

    Open rows and source meet in one exchange, by ranges of the key, and their
    outcome is stored once: the rows of new keys stand first in each range, in the
    order of their numbers.  ``resolve`` may fill columns of those rows, as the
    parent id, which no other row takes from the source.
    """
    if on_missing not in ("drop", "keep", "close"):
        raise ValueError("on_missing must be 'drop', 'keep' or 'close'")
    if on_duplicate not in ("fail", "latest"):
        raise ValueError("on_duplicate must be 'fail' or 'latest'")
    keys = names(key)
    incoming = source if sequence in source.columns else source.withColumn(sequence, F.lit(None).cast("bigint"))
    columns = incoming.columns
    aligned = evolve_to(target, incoming.schema, [start, end])
    is_open = F.col(end).eqNullSafe(F.lit(open_end))
    current, history = aligned.filter(is_open), aligned.filter(~is_open)

    fixed = {*keys, sequence, start, end, *skip}
    if parent_id:
        fixed.add(parent_id)
    hashed = [c for c in columns if c not in fixed]

    first = [c for c in names(order_by) if c not in keys]
    rest = [c for c in columns if c not in keys and c not in first and c != sequence]
    row = F.struct(*[F.col(f"`{c}`") for c in [*first, *rest]] or [F.lit(1).alias("_given")])
    new = incoming.select(*keys, F.lit(1).alias("_side"), row.alias("_new"))
    old = current.select(
        *keys, F.lit(0).alias("_side"), F.lit(None).cast(new.schema["_new"].dataType).alias("_new"),
        F.struct(*[F.col(f"`{c}`") for c in aligned.columns if c not in keys]).alias("_old"),
    )
    new = new.withColumn("_old", F.lit(None).cast(old.schema["_old"].dataType))
    sides = Window.partitionBy(*keys).orderBy("_side")
    whole = sides.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = {"_given": F.max("_side").over(whole) == 1, "_last": F.max("_new").over(whole), "_n": F.row_number().over(sides)}
    if on_duplicate == "fail":
        found["_other"] = F.min("_new").over(whole)
    both = old.unionByName(new).repartitionByRange(*keys).withColumns(found)
    # every open row, and one row of a key that has none
    pairs = both.where((F.col("_side") == 0) | (F.col("_n") == 1))
    bad_null = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    chosen = F.when(F.col("_given") & bad_null, F.raise_error(F.lit(f"null in key {keys}")))
    if on_duplicate == "fail":
        differs = F.col("_given") & ~F.col("_last").eqNullSafe(F.col("_other"))
        chosen = chosen.when(differs, F.raise_error(F.lit(f"key {keys} has different rows")))
    pairs = pairs.select(*keys, "_side", "_given", "_old", chosen.otherwise(F.col("_last")).alias("_new"))

    def version(number: Column, parent: Column | None) -> Column:
        parts = []
        for f in incoming.schema.fields:
            value = F.col(f"`{f.name}`") if f.name in keys else F.col(f"_new.`{f.name}`") if f.name != sequence else number
            if parent is not None and f.name == parent_id:
                value = parent
            parts.append(value.cast(f.dataType).alias(f.name))
        return F.struct(*parts, F.lit(as_of).alias(start), F.lit(open_end).alias(end))

    content = {side: row_hash([F.col(f"{side}.`{c}`") for c in hashed], legacy=legacy_hash) for side in ("_old", "_new")}
    kept = F.struct(*[F.col(f"`{c}`" if c in keys else f"_old.`{c}`").alias(c) for c in aligned.columns])
    closing = F.when(F.col(f"_old.`{start}`") == F.lit(as_of), F.lit(as_of)).otherwise(F.date_sub(F.lit(as_of), 1))
    closed = kept.withField(end, closing)
    opened = version(F.col(f"_old.`{sequence}`"), F.col(f"_old.`{parent_id}`") if parent_id else None)
    gone = {"drop": F.array().cast(pairs.select(F.array(kept)).schema[0].dataType), "keep": F.array(kept), "close": F.array(closed)}
    outcome = (
        F.when(F.col("_side") == 1, F.array(version(F.lit(None), None)))
        .when(~F.col("_given"), gone[on_missing])
        .when(content["_old"] == content["_new"], F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    rows = pairs.select((F.col("_side") == 1).alias("_fresh"), F.explode(outcome).alias("_row")).select("_fresh", "_row.*")
    merged = shifted(placed(rows, [F.col("_fresh").desc(), *keys], "merged"), F.col("_fresh"))
    last = int(aligned.agg(F.coalesce(F.max(sequence), F.lit(0)).alias("_last")).first()["_last"])
    number = (F.col("_place") + 1 + F.col("_shift") + last).cast(dict(aligned.dtypes)[sequence])
    known = merged.where(~F.col("_fresh")).select(*aligned.columns)
    fresh = merged.where("_fresh").withColumn(sequence, number).select(*aligned.columns)
    if resolve is not None:
        fresh = resolve(fresh).select(*aligned.columns)
    return known.unionByName(fresh).unionByName(history)


def classify_changes(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    skip: Sequence[str] = (),
    end: str = "end_dt",
    start: str = "start_dt",
    open_end: dt.date = OPEN_END,
    name: str = "change",
) -> DataFrame:
    """Key and outcome (insert, update, unchanged, missing, history) of a run."""
    keys = names(key)
    hashed = [c for c in source.columns if c not in {*keys, start, end, *skip}]
    aligned = evolve_to(target, source.schema, [start, end])
    is_open = F.col(end).eqNullSafe(F.lit(open_end))
    old = _with_hash(aligned.filter(is_open), hashed, "_old_hash", False).select(*keys, "_old_hash")
    new = _with_hash(unique_rows(source, keys), hashed, "_new_hash", False).select(*keys, "_new_hash")
    outcome = (
        F.when(F.col("_old_hash").isNull(), F.lit("insert"))
        .when(F.col("_new_hash").isNull(), F.lit("missing"))
        .when(F.col("_old_hash") == F.col("_new_hash"), F.lit("unchanged"))
        .otherwise(F.lit("update"))
    )
    live = old.join(new, keys, "full_outer").select(*keys, outcome.alias(name))
    return live.unionByName(aligned.filter(~is_open).select(*keys, F.lit("history").alias(name)))


def satellite_append(
    target: DataFrame | None,
    source: DataFrame,
    key: str,
    attributes: Sequence[str],
    hash_column: str = "diff_hash",
    load_column: str = "load_dtm",
) -> DataFrame:
    """Insert-only satellite: stored rows stay, unseen (key, content) rows come in.

    A source row whose key is new, or stored with other content, is added; one
    already stored is not.  That is a distinct over (key, attributes, hash)
    with the earliest load time, so one aggregate does it.
    """
    identity = [key, *attributes, hash_column]
    rows = source.select(*identity, load_column)
    if target is not None:
        rows = target.select(*identity, load_column).unionByName(rows)
    return rows.groupBy(*identity).agg(F.min(load_column).alias(load_column))


def with_hash_keys(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    hub: str = "fee_hub_hash",
    diff: str = "diff_hash",
    legacy_hash: bool = False,
) -> DataFrame:
    """Hub hash of the business key and diff hash of the sorted attributes."""
    return df.withColumns(
        {
            hub: F.md5(F.col(key).cast("string")),
            diff: row_hash(sorted(attributes), legacy=legacy_hash, separator=","),
        }
    )


def daily_windows(df: DataFrame, start: str, end: str, keep: Sequence[str] = ()) -> DataFrame:
    """Split ``[start, end]`` of each row into days that leave no gap.

    The first window begins at the given time, later ones at midnight.  All but
    the last end at the next midnight, which belongs to the next window; only the
    last holds its end, as ``till_included`` says.
    """
    first_day, last_day = F.col(start).cast("date"), F.col(end).cast("date")
    days = df.select(*keep, start, end, F.explode(F.sequence(first_day, last_day)).alias("_day"))
    last = F.col("_day") == last_day
    return days.select(
        *keep,
        F.col("_day").alias("window_day"),
        F.when(F.col("_day") == first_day, F.col(start).cast("timestamp_ntz")).otherwise(F.col("_day").cast("timestamp_ntz")).alias("window_from"),
        F.when(last, F.col(end).cast("timestamp_ntz")).otherwise(F.date_add("_day", 1).cast("timestamp_ntz")).alias("window_till"),
        last.alias("till_included"),
    )
