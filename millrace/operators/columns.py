"""Projection and column operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import names
from millrace.functions.constants import NO_VALUE_TEXTS
from millrace.functions.types import label_by, present, safe_cast, target_type, type_label
from millrace.operators.windows import number_rows


def add_column(
    df: DataFrame,
    name: str,
    values: Sequence | DataFrame,
    data_type: str | T.DataType | None = None,
    order_by: str | Sequence[str] = (),
    values_order: str | Sequence[str] = (),
) -> DataFrame:
    """Attach values by row position; rows past the last value are cut.

    Position means rank in ``order_by``, which must identify a row.  A list is
    matched against a distributed top-n of the same length; a frame (``name``
    plus its ``values_order`` columns) is numbered on the executors.
    """
    keys = names(order_by)
    if not keys:
        raise ValueError("add_column needs an order that identifies each row")
    spark = df.sparkSession
    if isinstance(values, DataFrame):
        left = number_rows(df, keys, "_position")
        right = number_rows(values.select(name, *[c for c in names(values_order) if c != name]), names(values_order), "_position")
        right = right.select("_position", F.col(name).cast(data_type) if data_type else F.col(name))
    else:
        kind = data_type if isinstance(data_type, T.DataType) else T._parse_datatype_string(data_type or "string")
        schema = T.StructType([T.StructField("_position", T.LongType()), T.StructField(name, kind)])
        right = spark.createDataFrame([(i + 1, v) for i, v in enumerate(values)], schema)
        # the list came from the driver, so its length bounds this top-n
        left = number_rows(df.orderBy(*keys).limit(len(values)), keys, "_position", buckets=1)
    return left.join(right, "_position").select(*df.columns, name)


def add_field(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def add_fields(df: DataFrame, fields: Iterable[Sequence]) -> DataFrame:
    """Several constant columns in one projection."""
    return df.withColumns({name: F.lit(value) for name, value in fields})


def add_computed(df: DataFrame, name: str, computation: Column | Callable, *columns: str, data_type="string") -> DataFrame:
    """New column from an expression.  A plain Python function is accepted as an
    escape hatch and gives text unless a type is named."""
    if isinstance(computation, Column):
        return df.withColumn(name, computation)
    return df.withColumn(name, F.udf(computation, data_type)(*columns))


def get_columns(df: DataFrame, *order: str) -> DataFrame:
    return df.select(*order)


def reorder_like(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.select(*target.columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that do not exist are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def null_columns(df: DataFrame, how: str = "any") -> list[str]:
    """Columns with any / only nulls, from one aggregate over the table."""
    if how not in ("any", "all"):
        raise ValueError("how must be 'any' or 'all'")
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    limit = row["_rows"] if how == "any" else 1
    return [c for c in df.columns if row[c] < limit]


def drop_null_columns(df: DataFrame, how: str = "any") -> DataFrame:
    return df.drop(*null_columns(df, how))


def cut_out(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    return df.drop(*names(columns))


def convert(df: DataFrame, columns: str | Iterable[str], conversion: Callable[[Column], Column], data_type=None) -> DataFrame:
    """Rewrite columns with a Column -> Column function and an optional type."""
    chosen = names(columns)
    missing = [c for c in chosen if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")

    results = {c: conversion(F.col(f"`{c}`")) for c in chosen}
    if data_type:
        name = data_type if isinstance(data_type, str) else data_type.simpleString()
        kinds = df.select(*results.values()).dtypes
        results = {c: safe_cast(r, kind, name) for (c, r), (_, kind) in zip(results.items(), kinds)}
    return df.withColumns(results)


def convert_when(
    df: DataFrame,
    column: str,
    conversion: Callable[[Column], Column],
    condition: str | Column,
    dedupe_unchanged: bool = False,
) -> DataFrame:
    """Rewrite a column where the condition is true; other rows stay as they are.

    ``dedupe_unchanged`` also collapses identical unchanged rows, which is what
    a set difference based formulation does.
    """
    test = F.expr(condition) if isinstance(condition, str) else condition
    hit = F.coalesce(test, F.lit(False))
    current = F.col(f"`{column}`")
    if not dedupe_unchanged:
        return df.withColumn(column, F.when(hit, conversion(current)).otherwise(current))
    changed = df.filter(hit).withColumn(column, conversion(current))
    return changed.unionByName(df.filter(~hit).distinct())


def to_float(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, safe_cast(F.col(column), dict(df.dtypes)[column], "float"))


def to_int(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, safe_cast(F.col(column), dict(df.dtypes)[column], "int"))


def to_string(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


def first_value(df: DataFrame, name: str, *columns: str, no_value: Sequence[str] = NO_VALUE_TEXTS) -> DataFrame:
    """First column, in the given order, that holds a real value."""
    kinds = dict(df.dtypes)

    def usable(c: str) -> Column:
        value = F.col(f"`{c}`")
        good = ~value.cast("string").isin(list(no_value))
        if kinds[c] in ("float", "double"):
            good = good & ~F.isnan(value)
        return F.when(good, value)

    return df.withColumn(name, F.coalesce(*[usable(c) for c in columns]))


def _typed_values(df: DataFrame, columns: Iterable[Mapping], truncate: bool) -> list[tuple[Mapping, Column]]:
    """Column records in sequence order, each with its typed value."""
    records = sorted(columns, key=lambda r: int(r["sequence_number"]))
    values = []
    for record in records:
        value = F.col(record["source_column_name"])
        if present(record.get("target_datetime_format")):
            # a plain cast would end the job at the first unreadable text
            value = F.date_format(value.try_cast("timestamp"), record["target_datetime_format"])
        values.append(value)
    found = []
    for record, value, (_, kind) in zip(records, values, df.select(*values).dtypes):
        length = record.get("target_length")
        wanted = target_type(record["target_datatype"], length, record.get("target_precision"))
        value = safe_cast(value, kind, wanted)
        if truncate and wanted == "string" and present(length):
            value = F.substring(value, 1, int(length))
        found.append((record, value))
    return found


#: Map of source column and text that a typed row could not take.
RESCUED = "_rescued"


def typed_rescue(df: DataFrame, columns: Iterable[Mapping], keep: Sequence[str] = (), truncate: bool = False, rescued: str = RESCUED) -> DataFrame:
    """``typed_select`` with one column more: the source values that did not fit, as a map of source column and text.

    The map is empty for a good row.  Nulls and blank texts are absent values, not
    bad ones.  ``split_rescued`` parts good rows from bad ones.
    """
    typed = _typed_values(df, columns, truncate)
    cells = []
    for record, value in typed:
        raw = F.col(record["source_column_name"])
        bad = raw.isNotNull() & (F.trim(raw.cast("string")) != "") & value.isNull()
        cells.append(F.struct(F.lit(record["source_column_name"]).alias("key"), raw.cast("string").alias("value"), bad.alias("bad")))
    bad_cells = F.transform(F.filter(F.array(*cells), lambda c: c["bad"]), lambda c: F.struct(c["key"].alias("key"), c["value"].alias("value")))
    chosen = [value.alias(record["target_column_name"]) for record, value in typed]
    return df.select(*chosen, *[F.col(c) for c in keep if c in df.columns], F.map_from_entries(F.array_distinct(bad_cells)).alias(rescued))


def split_rescued(typed: DataFrame, rescued: str = RESCUED) -> tuple[DataFrame, DataFrame]:
    """(good rows without the map, bad rows with it)."""
    return typed.where(F.size(rescued) == 0).drop(rescued), typed.where(F.size(rescued) > 0)


def error_records(bad: DataFrame, table: str, keys: Sequence[str], rescued: str = RESCUED) -> DataFrame:
    """Bad rows as records of the error table: table_name, primary_keys and bad_values as JSON.

    A row whose own key did not fit has null primary_keys: no stored row can be
    the one it means.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(f"`{k}`").isNotNull()
    key = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys])) if keys else F.lit(None).cast("string")
    return bad.select(F.lit(table).alias("table_name"), F.when(whole, key).alias("primary_keys"), F.to_json(rescued).alias("bad_values"))


def typed_select(df: DataFrame, columns: Iterable[Mapping], keep: Sequence[str] = (), truncate: bool = False) -> DataFrame:
    """Project a raw table through its column records.

    Records are ordered by sequence number; each casts one source column to its
    target type (null when the value does not fit) and renames it.  A target
    date-time format rewrites the value through ``date_format`` first; a text that
    is no date or time gives null.
    Character lengths cut the text only when ``truncate`` is set.
    """
    chosen = [value.alias(record["target_column_name"]) for record, value in _typed_values(df, columns, truncate)]
    chosen += [F.col(c) for c in keep if c in df.columns]
    return df.select(*chosen)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def evolve_to(target: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
    """Align a stored table with a new source schema: new columns become typed
    nulls, columns the source dropped go away, ``extra`` columns stay."""
    have = set(target.columns)
    aligned = [
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    return target.select(*aligned, *extra)


def map_labels(df: DataFrame, column: str, labels: Mapping[str, str]) -> DataFrame:
    """Replace known values by their label, keep the others."""
    return df.withColumn(column, label_by(F.col(column), labels, F.col(column)))


def label_types(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, type_label(F.col(column)))


def explode_pairs(df: DataFrame, column: str, name: str = "col_name", kind: str = "col_type") -> DataFrame:
    """Array of ``('name', 'type')`` texts -> one row per pair."""
    parts = df.withColumn("_pair", F.explode(column))
    pieces = F.split("_pair", ", ")
    return parts.select(
        *[c for c in df.columns if c != column],
        F.translate(pieces.getItem(0), "'( ", "").alias(name),
        F.translate(pieces.getItem(1), "') ", "").alias(kind),
    )


def full_row_key(df: DataFrame, name: str = "FullKey", separator: str = "|", null_text: str = "") -> DataFrame:
    """Key made of every column; null parts are kept in place."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_text)) for c in df.columns]
    return df.select(F.concat_ws(separator, *parts).alias(name), *[F.col(f"`{c}`") for c in df.columns])


def last_value_by_key(df: DataFrame, key: str, value: str, order_by: str | Sequence[str]) -> DataFrame:
    """One row per key with the value of its last row in ``order_by``."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*names(order_by))).alias(value))


def to_dict(df: DataFrame, key: str, value: str, order_by: str | Sequence[str], *, limit: int) -> dict:
    """Driver-side dictionary of at most ``limit`` keys, a bound the caller names; more are an error."""
    rows = last_value_by_key(df, key, value, order_by).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} keys; keep this lookup as a DataFrame")
    return {r[key]: r[value] for r in rows}


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def select_environment(
    df: DataFrame,
    column: str,
    environment: str,
    name: str = "location",
    *,
    prefix: str,
    suffix: str = "/data/final",
    bucket_field: str = "target_bucket_name",
) -> DataFrame:
    """Location of one environment out of a JSON list of environment records."""
    shape = T.ArrayType(
        T.StructType([T.StructField("environment_name", T.StringType()), T.StructField(bucket_field, T.StringType())])
    )
    wanted = F.filter(
        F.from_json(F.col(column), shape), lambda e: F.lower(e["environment_name"]) == environment.lower()
    )
    # a repeated environment name is resolved to its last record
    bucket = F.try_element_at(wanted, F.lit(-1))[bucket_field]
    return df.withColumn(name, F.concat(F.lit(prefix), bucket, F.lit(suffix)))


def to_json_columns(df: DataFrame) -> DataFrame:
    """Every column as text: nested values as JSON, scalars by cast."""

    def text(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(value).alias(field.name)
        return value.cast("string").alias(field.name)

    return df.select(*[text(f) for f in df.schema.fields])


def all_strings(df: DataFrame, nan_text: str = "NaN") -> DataFrame:
    """Every column as text with the NaN text as null."""
    return df.select(
        *[F.nullif(F.col(f"`{c}`").cast("string"), F.lit(nan_text)).alias(c) for c in df.columns]
    )


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
