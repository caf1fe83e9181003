"""Join operators.

No operator carries a broadcast hint: Catalyst and adaptive execution compare
the measured size of a side with the session's threshold, and split skewed
partitions of a shuffled side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import match_keys, names
from millrace.functions.constants import OPEN_END_FAR, OPEN_TERM_TS
from millrace.functions.hashing import tagged
from millrace.operators.sets import distinct_rows
from millrace.operators.windows import first_per_group
from millrace.scratch import stage


# rows of one key above which an outer join treats it apart
HOT_ROWS = 1_000_000


def _free_names(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    taken = set(left.columns)
    return right.withColumnsRenamed({c: c + suffix for c in right.columns if c in taken and c not in keys})


SLOTS = "_slots"


def _hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int, slots: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, stored with the slots to spread them over; at most rows / hot_rows of them."""
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return stage(counts.filter(F.col("_rows") > hot_rows).select(*keys, F.lit(slots).cast("bigint").alias(SLOTS)), "hot-keys")


def measured_keys(sides: Sequence[DataFrame], keys: Sequence[str], tasks: int) -> list[DataFrame]:
    """Per side: the keys that have more rows than an even task would, with the slots that bring them down to that.

    One pass over the sides' keys keeps a sketch of frequent items per task, and
    only sketches are exchanged.  A sketch holds every key of more than a third of
    an even task's rows; the candidates, a few per task, are then counted exactly.
    """
    digest = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    seen = [df.dropna(subset=list(keys)).select(digest.alias("h"), F.lit(n).alias("side")) for n, df in enumerate(sides)]
    measures = [F.expr(m) for n in range(len(sides)) for m in (f"count_if(side = {n})", f"approx_top_k(h, {2 * tasks}, {16 * tasks}) FILTER (WHERE side = {n})")]
    found = reduce(DataFrame.unionByName, seen).agg(*measures).first()
    hot = []
    for n, df in enumerate(sides):
        even = max(1, found[2 * n] // tasks)
        likely = [i["item"] for i in found[2 * n + 1] or [] if i["item"] is not None]
        rows = df.dropna(subset=list(keys)).where(digest.isin(likely)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        slots = F.least(F.ceil(F.col("_rows") / F.lit(even)), F.lit(tasks)).cast("bigint")
        hot.append(stage(rows.where(F.col("_rows") > even).select(*keys, slots.alias(SLOTS)), "hot-keys"))
    return hot


def _salted(many: DataFrame, few: DataFrame, hot: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi join that spreads every key of ``many`` over its slots and repeats ``few``
    for each slot.  The slot depends on the row and on the partition it is read
    from, so copies spread too and a task that runs again gives the same one."""
    text = F.concat_ws(",", *[tagged(F.col(f"`{c}`").try_cast("string")) for c in many.columns])
    slot = F.pmod(F.xxhash64(text) + F.spark_partition_id(), F.col(SLOTS)).cast("bigint")
    left = match_keys(many, hot, keys, "inner").withColumn("_slot", slot).drop(SLOTS)
    right = match_keys(few, hot, keys, "inner").withColumn("_slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(SLOTS) - 1))).drop(SLOTS)
    return left.join(right, [*keys, "_slot"], how).drop("_slot")


def _hot_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hot_right: DataFrame, hot_left: DataFrame | None) -> DataFrame:
    """Left or full outer join whose hot keys are joined apart, salted.

    Adaptive execution splits only the kept side of an outer join.  A key with
    many rows on the other side (or on any side of a full outer join) is taken
    out here; a salted key always exists on its many side, so nothing is lost.
    """
    order = [*left.columns, *[c for c in right.columns if c not in keys]]
    outer = how == "full_outer"
    parts, cold_left, cold_right = [], left, right

    def pick(df: DataFrame, hot: DataFrame, kind: str) -> DataFrame:
        return match_keys(df, hot, keys, kind)

    if not hot_right.isEmpty():
        parts.append(_salted(right, left, hot_right, keys, "left" if outer else "inner").select(*order))
        cold_left, cold_right = pick(cold_left, hot_right, "left_anti"), pick(cold_right, hot_right, "left_anti")
    if outer:
        # rows with a null key match nothing
        missing = reduce(lambda x, y: x | y, [F.col(f"`{k}`").isNull() for k in keys])
        parts += [cold_left.filter(missing), cold_right.filter(missing)]
        cold_left, cold_right = cold_left.filter(~missing), cold_right.filter(~missing)
        # a key that is hot on both sides is done already
        hot_left = match_keys(hot_left, hot_right, keys, "left_anti")
        if not hot_left.isEmpty():
            parts.append(_salted(cold_left, cold_right, hot_left, keys, "left").select(*order))
            cold_left, cold_right = pick(cold_left, hot_left, "left_anti"), pick(cold_right, hot_left, "left_anti")
    parts.append(cold_left.join(cold_right, list(keys), how).select(*order))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts).select(*order)


def _may_skew(df: DataFrame) -> bool:
    """Whether the side is as large as a partition has to be for the session to call it skewed."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().getConfString("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256MB")
    limit = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(threshold)
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > limit


def _equi(left: DataFrame, right: DataFrame, keys, how: str, suffix: str, hot_rows: int | None = None) -> DataFrame:
    keys = names(keys)
    right = _free_names(left, right, keys, suffix)
    outer = how == "full_outer"
    if how != "inner":
        tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if hot_rows is not None:
            hot = [_hot_keys(df, keys, hot_rows, tasks) for df in ([right, left] if outer else [right])]
            return _hot_join(left, right, keys, how, hot[0], hot[1] if outer else None)
        sides = [df for df in ([right, left] if outer else [right]) if _may_skew(df)]
        if sides:
            found = measured_keys([right, left] if outer else [right], keys, tasks)
            if not all(f.isEmpty() for f in found):
                return _hot_join(left, right, keys, how, found[0], found[1] if outer else None)
    rest = [c for c in right.columns if c not in keys]
    return left.join(right, keys, how).select(*left.columns, *rest)


def inner_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], suffix: str = "_right") -> DataFrame:
    return _equi(left, right, keys, "inner", suffix)


def left_join(
    left: DataFrame, right: DataFrame, keys: str | Sequence[str], suffix: str = "_right", hot_rows: int | None = None
) -> DataFrame:
    """Keys with so many rows on the right that one task would get far more than
    the others are joined apart, spread over tasks by their weight: adaptive
    execution cannot split that side.  A side below the session's size of a skewed
    partition is not measured.  With ``hot_rows``, keys of more rows than that are
    counted and spread instead."""
    return _equi(left, right, keys, "left", suffix, hot_rows)


def outer_join(
    left: DataFrame, right: DataFrame, keys: str | Sequence[str], suffix: str = "_right", hot_rows: int | None = None
) -> DataFrame:
    """Full outer join with one set of key columns; ``hot_rows`` as in
    ``left_join``, for both sides."""
    return _equi(left, right, keys, "full_outer", suffix, hot_rows)


def join(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str] | None = None,
    left_keys: str | Sequence[str] | None = None,
    right_keys: str | Sequence[str] | None = None,
    suffix: str = "_right",
) -> DataFrame:
    """Inner join; keys with different names keep the left key columns."""
    if keys is not None:
        return inner_join(left, right, keys, suffix)
    return _keyed(left, right, left_keys, right_keys, "inner", suffix).drop(*[f"_{c}" for c in names(right_keys)])


def left_join_on(left: DataFrame, right: DataFrame, left_keys, right_keys, suffix: str = "_right") -> DataFrame:
    """Left join on differently named keys; both key sets stay in the result."""
    joined = _keyed(left, right, left_keys, right_keys, "left", suffix)
    return joined.withColumnsRenamed(
        {f"_{c}": (c + suffix if c in left.columns else c) for c in names(right_keys)}
    )


def _keyed(left: DataFrame, right: DataFrame, left_keys, right_keys, how: str, suffix: str) -> DataFrame:
    left_keys, right_keys = names(left_keys), names(right_keys)
    if len(left_keys) != len(right_keys):
        raise ValueError("left and right key lists differ in length")
    right = _free_names(left, right, right_keys, suffix).withColumnsRenamed({c: f"_{c}" for c in right_keys})
    condition: Column = F.lit(True)
    for l, r in zip(left_keys, right_keys):
        condition = condition & (left[l] == right[f"_{r}"])
    return left.join(right, condition, how)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str] | None = None,
    left_keys=None,
    right_keys=None,
    order_by: str | Sequence[str] = (),
) -> DataFrame:
    """Left join to the first right row per key, in ``order_by``."""
    right_names = names(keys if keys is not None else right_keys)
    left_names = names(keys if keys is not None else left_keys)
    one = _free_names(left, first_per_group(right, right_names, order_by), right_names, "_right")
    return match_keys(left, one, left_names, "left", right_names, nulls_match=False)


def anti_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Left rows whose whole key does not occur on the right."""
    keys = names(keys)
    return match_keys(left, right.select(*keys).distinct(), keys, "left_anti", nulls_match=False)


def surrogate_lookup(
    source: DataFrame,
    lookup: DataFrame,
    natural_keys: Sequence[str],
    surrogate: str,
    foreign_key: str,
    source_keys: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Replace the natural key columns by the looked-up surrogate key."""
    if len(natural_keys) != len(source_keys):
        raise ValueError("natural keys and source keys differ in length")
    keyed = lookup.select(
        *[F.col(n).alias(s) for n, s in zip(natural_keys, source_keys)], F.col(surrogate).alias("_surrogate")
    )
    joined = source.join(keyed, list(source_keys), how).drop(*source_keys)
    return joined.withColumnRenamed("_surrogate", foreign_key)


def exclude_quarantined(
    df: DataFrame, errors: DataFrame, table: str, keys: str | Sequence[str], column: str = "primary_keys"
) -> DataFrame:
    """Drop the rows whose primary key stands, as JSON, in the error table.

    The JSON is parsed with the types of the table's own key columns.  A key text
    that does not give every key column stops the job, as the row it means would
    be loaded otherwise.  A record without a key text names no row (its own key was
    unreadable, or a whole file was) and holds nothing back.
    """
    keys = names(keys)
    fields = {f.name: f.dataType for f in df.schema.fields}
    shape = T.StructType([T.StructField(k, fields[k]) for k in keys])
    bad = (
        errors.filter(F.col("table_name") == table)
        .select(F.col(column).alias("_text"), F.from_json(F.col(column), shape).alias("_key"))
    )
    whole = reduce(lambda a, b: a & b, [F.col("_key").getField(k).isNotNull() for k in keys])
    unread = F.raise_error(F.concat(F.lit(f"unreadable key of {table}: "), F.col("_text")))
    # the check is part of every key, so it cannot be pruned away
    checked = [F.when(whole | F.col("_text").isNull(), F.col("_key").getField(k)).otherwise(unread.cast(fields[k])).alias(k) for k in keys]
    bad = bad.select(*checked).distinct()
    return match_keys(df, bad, keys, "left_anti", nulls_match=False)


def propagate_parent_id(
    child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]], parent_id: str, distinct: bool = True
) -> DataFrame:
    """Overwrite the child's copy of the parent id with the one found on the
    natural columns; ``on`` lists (child column, parent column)."""
    own, parents = [c for c, _ in on], [f"_p{i}" for i in range(len(on))]
    keyed = parent.select(
        *[F.col(p).alias(n) for n, (_, p) in zip(parents, on)], F.col(parent_id).alias("_parent_id")
    ).distinct()
    order = child.columns if parent_id in child.columns else [*child.columns, parent_id]
    joined = match_keys(child.drop(parent_id), keyed, own, "left", parents, nulls_match=False)
    result = joined.withColumnRenamed("_parent_id", parent_id).select(*order)
    return result.distinct() if distinct else result


def semi_changed(source: DataFrame, target: DataFrame, key: str, hash_column: str) -> DataFrame:
    """Source rows whose key is stored with a different hash.

    Some stored hash differs exactly when the smallest or the largest does, so
    one row per key is enough on the stored side.
    """
    ends = target.groupBy(F.col(key).alias("_key")).agg(F.min(hash_column).alias("_low"), F.max(hash_column).alias("_high"))
    own = F.col(f"s.`{hash_column}`")
    condition = F.col(f"s.`{key}`").eqNullSafe(F.col("e._key")) & ((own != F.col("e._low")) | (own != F.col("e._high")))
    return source.alias("s").join(ends.dropna(subset=["_key"]).alias("e"), condition, "left_semi")


def effective_join(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    as_of: dt.datetime,
    effective: str = "EFFT_DTM",
    term: str | None = "TERM_DTM",
    end: str = "END_DTM",
    take: Sequence[str] = (),
    open_end: dt.date = OPEN_END_FAR,
) -> DataFrame:
    """Left join to the dimension rows in force at the start of ``as_of``'s year.

    The validity test is on the dimension alone, so it runs before the join.
    """
    year_start = F.lit(dt.datetime(as_of.year, 1, 1).isoformat(sep=" ")).cast("timestamp_ntz")
    valid = (F.col(end).cast("date") == F.lit(open_end)) & (year_start > F.col(effective).cast("timestamp_ntz"))
    limit = F.lit(OPEN_TERM_TS).cast("timestamp_ntz")
    if term is not None:
        valid = valid & (year_start <= F.coalesce(F.col(term).cast("timestamp_ntz"), limit))
    wanted = dimension.filter(valid).select(F.col(dimension_key).alias("_key"), *take)
    return fact.join(wanted, fact[fact_key] == wanted["_key"], "left").drop("_key")


def crosswalk(df: DataFrame, lookup: DataFrame, column: str, lookup_column: str, take: str) -> DataFrame:
    """Distinct rows left-joined to the distinct pairs of a reference table.

    Distinct rows and pairs make distinct links; only where the two columns differ
    in type, so that several references may equal one value, copies are sought again.
    """
    pairs = lookup.select(F.col(lookup_column).alias("_ref"), F.col(take)).distinct()
    base = distinct_rows(df)
    linked = base.join(pairs, base[column] == pairs["_ref"], "left").drop("_ref")
    alike = base.select(column).schema[0].dataType == pairs.schema["_ref"].dataType
    return linked if alike else linked.distinct()
