"""Inventory records: what one configured ingestion reads, types and writes."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from millrace.functions.types import present


def as_list(value) -> list:
    """List-valued fields may arrive as JSON or literal text; empty means none."""
    if value in (None, "", "null", [], ()):
        return []
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except json.JSONDecodeError:
            value = ast.literal_eval(re.sub(r"\bnull\b", "None", value))
    return list(value)


@dataclass(frozen=True)
class Ingestion:
    pipeline_id: str
    table: str
    columns: tuple[Mapping, ...]
    load_type: str = "full"
    version_number: str = "1"
    app_name: str = ""
    domain_name: str = ""
    keys: tuple[str, ...] = ()
    change_times: tuple[str, ...] = ()
    op_column: str | None = None
    partition_col: str | None = None
    source: Mapping = field(default_factory=dict)
    sla: str = ""
    ola: str = ""
    active: bool = True

    @classmethod
    def from_record(cls, record: Mapping) -> Ingestion:
        op = as_list(record.get("log_chng_indicator_key"))
        partition = record.get("target_partition_col")
        return cls(
            pipeline_id=record["pipeline_id"],
            table=record.get("target_file_name") or record.get("target_table_name"),
            columns=tuple(as_list(record["pipeline_columns"])),
            load_type=record.get("load_type") or "full",
            version_number=str(record.get("version_number", "1")),
            app_name=record.get("app_name", ""),
            domain_name=record.get("domain_name", ""),
            keys=tuple(as_list(record.get("primary_key_set"))),
            change_times=tuple(as_list(record.get("cdc_timestamp_key"))),
            op_column=op[0] if op else None,
            partition_col=partition if present(partition) else None,
            source={k: v for k, v in record.items() if k.startswith("source_")},
            sla=record.get("sla") or "",
            ola=record.get("ola") or "",
            active=str(record.get("active", "true")).lower() in ("", "true", "none"),
        )


def environment_settings(environments, name: str) -> dict:
    """Settings of one environment out of the record's list; names ignore case,
    later records override earlier ones."""
    merged: dict = {}
    for entry in as_list(environments):
        if entry["environment_name"].lower() == name.lower():
            merged.update(entry)
    return merged
