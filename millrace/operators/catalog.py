"""Catalogue feeds and inventory tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.constants import UNLABELLED_PROCESSED
from millrace.functions.types import type_label
from millrace.operators.aggregates import pack_json
from millrace.operators.columns import map_labels, select_environment, to_json_columns
from millrace.operators.filters import active_published
from millrace.operators.windows import first_per_group
from millrace.scratch import stage

# columns of a catalogue feed, in order
FEED_COLUMNS = (
    "Full Name",
    "Name",
    "Community",
    "Domain Type",
    "Domain",
    "Asset Type",
    "Data Type",
    "Data Type Precision",
    "Size",
    "Data Classification",
    "File Location",
    "Format",
    "Description",
    "is part of [Table] > Name",
    "is part of [Table] > Full Name",
    "is part of [Table] > Community",
    "is part of [Table] > Domain",
)

DOMAIN_TYPE = "Physical Data Dictionary"


def _feed(df: DataFrame, asset: str, domain: str, values: dict[str, Column]) -> DataFrame:
    fixed = {"Domain Type": F.lit(DOMAIN_TYPE), "Domain": F.lit(domain), "Asset Type": F.lit(asset)}
    filled = {**fixed, **values}
    return df.select(*[filled.get(c, F.lit("")).cast("string").alias(c) for c in FEED_COLUMNS])


def raw_feed(
    inventory: DataFrame, columns: DataFrame, classification: DataFrame, environment: str, *, labels: Mapping[str, str], prefix: str
) -> DataFrame:
    """One *Table* row per published table and one *Column* row per column.

    ``labels`` names the communities of the domains, ``prefix`` the store.  Columns
    of unpublished tables and repeated ones go before the classification is joined.
    """
    active = map_labels(active_published(inventory), "domain_name", labels)
    active = select_environment(active, "target_environments", environment, prefix=prefix)
    table = F.concat_ws("", "target_file_name", "target_table_name")
    active = active.select(
        "pipeline_id", "domain_name", "pipeline_desc", "location", table.alias("table_name")
    )
    described = columns.select(
        "column_id", "pipeline_id", "target_column_name", F.lower("target_datatype").alias("datatype"),
        "target_length", "target_precision", "target_datetime_format",
    )
    rows = described.join(active, "pipeline_id").drop("pipeline_id")
    # the smallest column id survives when a table lists a column twice
    rows = first_per_group(rows, ["domain_name", "table_name", "target_column_name"], ["column_id"])
    known = classification.select("column_id", "classification_level", "business_description")
    rows = rows.join(first_per_group(known, "column_id", "classification_level"), "column_id", "left")
    # both kinds of feed rows are made from these
    rows = stage(rows.fillna({"classification_level": "INTERNAL", "target_length": "0"}), "feed")

    tables = rows.select("domain_name", "table_name", "pipeline_desc", "location").distinct()
    full = F.concat_ws(" > ", "target_column_name", "table_name")
    table_rows = _feed(tables, "Table", "Raw", {
        "Full Name": F.col("table_name"),
        "Name": F.col("table_name"),
        "Community": F.col("domain_name"),
        "File Location": F.concat_ws("/", "location", "table_name"),
        "Description": F.col("pipeline_desc"),
    })
    column_rows = _feed(rows, "Column", "Raw", {
        "Full Name": full,
        "Name": F.col("target_column_name"),
        "Community": F.col("domain_name"),
        "Data Type": type_label(F.col("datatype")),
        "Data Type Precision": F.col("target_precision"),
        "Size": F.col("target_length"),
        "Data Classification": F.col("classification_level"),
        "Format": F.col("target_datetime_format"),
        "Description": F.col("business_description"),
        "is part of [Table] > Name": F.col("table_name"),
        "is part of [Table] > Full Name": full,
        "is part of [Table] > Community": F.col("domain_name"),
        "is part of [Table] > Domain": F.lit("Raw"),
    })
    return table_rows.unionByName(column_rows)


def processed_feed(events: DataFrame, *, labels: Mapping[str, str]) -> DataFrame:
    """Feed of the stored tables, from the closing lineage events of all domains; ``labels`` as in ``raw_feed``."""
    final = map_labels(events.filter(F.col("transformation_func_nm") == "Final"), "domain_name", labels)
    table_rows = _feed(final, "Table", "Processed", {
        "Full Name": F.lower("target_tables"),
        "Name": F.lower("target_tables"),
        "Community": F.col("domain_name"),
        "File Location": F.col("final_path"),
    })
    pair = F.explode("final_df_cols").alias("pair")
    parts = final.select("domain_name", "target_tables", pair).select(
        "domain_name",
        "target_tables",
        F.translate(F.split("pair", ", ").getItem(0), "'( ", "").alias("col_name"),
        F.translate(F.split("pair", ", ").getItem(1), "') ", "").alias("col_type"),
    )
    column_rows = _feed(parts, "Column", "Processed", {
        "Full Name": F.concat_ws(" > ", F.lower("col_name"), "target_tables"),
        "Name": F.lower("col_name"),
        "Community": F.col("domain_name"),
        # ``decimal(12,2)`` splits inside the type text; the base name decides
        "Data Type": type_label(F.col("col_type"), UNLABELLED_PROCESSED),
        "is part of [Table] > Name": F.col("target_tables"),
        "is part of [Table] > Full Name": F.concat_ws(" > ", "col_name", "target_tables"),
        "is part of [Table] > Community": F.col("domain_name"),
        "is part of [Table] > Domain": F.lit("Processed"),
    })
    return table_rows.unionByName(column_rows)


def column_manifest(df: DataFrame) -> DataFrame:
    """Column names and types of a dataset as one JSON text."""
    entries = [F.struct(F.lit(n).alias("Column_Name"), F.lit(t).alias("Type")) for n, t in df.dtypes]
    listed = F.struct(F.array(*entries).alias("ColumnList"))
    return df.sparkSession.range(1).select(F.to_json(listed).alias("manifest"))


def pack_inventory(inventory: DataFrame, columns: DataFrame, fields: Sequence[str], *, page_rows: int) -> DataFrame:
    """Inventory records as text with their columns packed into one JSON array.

    ``fields`` are the column-record fields, sorted in that order; one row per
    (pipeline, version, part).
    """
    keys = ["pipeline_id", "version_number"]
    packed = pack_json(columns, keys, fields, "pipeline_columns", page_rows=page_rows)
    packed = packed.withColumns({k: F.col(k).cast("string") for k in keys})
    return to_json_columns(inventory).join(packed, keys)


def write_inventory(packed: DataFrame, path: str) -> None:
    """One folder of JSON records per application."""
    packed.write.mode("overwrite").partitionBy("app_name").json(path)


def latest_versions(inventory: DataFrame) -> DataFrame:
    """Newest active version per pipeline; an empty flag counts as active."""
    flag = F.lower(F.coalesce(F.nullif(F.col("active").cast("string"), F.lit("")), F.lit("true")))
    return inventory.filter(flag == "true").groupBy("pipeline_id").agg(F.max("version_number").alias("version_number"))


def choose_pipelines(inventory: DataFrame, wanted: DataFrame) -> DataFrame:
    """Requested pipelines with the version to run; ``found`` is false for ids
    without an active version, or whose latest version is another one."""
    latest = latest_versions(inventory).withColumnRenamed("version_number", "_latest")
    joined = wanted.join(latest, "pipeline_id", "left")
    asked = F.col("version_number")
    found = F.col("_latest").isNotNull() & (asked.isNull() | (asked == F.col("_latest")))
    return joined.select("pipeline_id", F.when(found, F.col("_latest")).alias("version_number"), found.alias("found"))
