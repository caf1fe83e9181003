"""Lineage events, root sources and recorded SQL."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import match_keys, names
from millrace.scratch import stage

_LISTS = ("added_col", "selected_cols", "dropped_cols", "left_df_cols", "right_df_cols", "key_cols",
          "left_key_cols", "right_key_cols", "final_df_cols", "source_tables")
_TEXTS = ("script_name", "domain_name", "transformation_func_nm", "renamed_cols", "left_df_id", "right_df_id",
          "target_tables", "sql_text", "final_path")

EVENT_SCHEMA = T.StructType(
    [T.StructField("exec_ts", T.TimestampNTZType())]
    + [T.StructField(n, T.StringType()) for n in _TEXTS]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in _LISTS]
)


def column_pairs(df: DataFrame) -> list[str]:
    return [str(pair) for pair in df.dtypes]


@dataclass
class LineageLog:
    """Events of one script, in order.  Datasets carry the names given to them."""

    script_name: str
    domain_name: str
    events: list[dict] = field(default_factory=list)

    def record(self, step: str, target: str, at: dt.datetime, **details) -> None:
        unknown = set(details) - set(_LISTS) - set(_TEXTS)
        if unknown:
            raise ValueError(f"unknown lineage fields: {sorted(unknown)}")
        renamed = details.pop("renamed_cols", None)
        event = {"script_name": self.script_name, "domain_name": self.domain_name, "exec_ts": at,
                 "transformation_func_nm": step, "target_tables": target, **details}
        if renamed is not None:
            event["renamed_cols"] = renamed if isinstance(renamed, str) else json.dumps(renamed, sort_keys=True)
        self.events.append(event)

    def apply(
        self,
        operator: Callable[..., DataFrame],
        inputs: Mapping[str, DataFrame],
        target: str,
        at: dt.datetime,
        *arguments,
        details: Mapping | None = None,
        **options,
    ) -> DataFrame:
        """Run an operator on named frames and record what it did to the columns."""
        frames = list(inputs.items())
        result = operator(*[df for _, df in frames], *arguments, **options)
        before = {c for _, df in frames for c in df.columns}
        after = set(result.columns)
        event = {
            "source_tables": [n for n, _ in frames],
            "added_col": [c for c in result.columns if c not in before],
            "dropped_cols": sorted(before - after),
            "selected_cols": list(frames[0][1].columns),
            "final_df_cols": column_pairs(result),
        }
        for side, (name, df) in zip(("left", "right"), frames if len(frames) > 1 else []):
            event[f"{side}_df_cols"] = column_pairs(df)
            event[f"{side}_df_id"] = name
        event.update(details or {})
        self.record(operator.__name__, target, at, **event)
        return result

    def finish(self, df: DataFrame, target: str, path: str, at: dt.datetime, sources: Sequence[str] = ()) -> None:
        """The closing event of a stored table; the catalogue feed reads these."""
        self.record("Final", target, at, final_df_cols=column_pairs(df), final_path=path, source_tables=list(sources))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [[e.get(f.name) for f in EVENT_SCHEMA.fields] for e in self.events]
        return spark.createDataFrame(rows, EVENT_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """Append the events to the stored lineage table."""
        self.to_frame(spark).coalesce(1).write.mode("append").parquet(path)

    def sql(self, spark: SparkSession, query: str, sources: Mapping[str, DataFrame], target: str, at: dt.datetime) -> DataFrame:
        """Run SQL over named frames (written as ``{name}`` in the text) and record it."""
        result = spark.sql(query, **sources)
        self.record("sparkSql", target, at, sql_text=query, source_tables=list(sources), final_df_cols=column_pairs(result))
        return result


def edges_of(events: DataFrame) -> DataFrame:
    """(target, source) pairs of the events."""
    return events.select(
        F.col("target_tables").alias("target"), F.explode("source_tables").alias("source")
    ).distinct()


def root_sources(edges: DataFrame, targets: DataFrame | str | Sequence[str] | None = None) -> DataFrame:
    """(target, root) for every dataset without sources of its own that a target
    is built from; all targets unless some are named.

    Steps double: a round knows the roots within 2^k steps, and which datasets
    lie exactly 2^k steps above; put together they give twice as many.  A chain of
    n steps takes log2(n) + 1 rounds.  Ways along a cycle never end, but none
    without repetition is longer than the number of datasets, which bounds the
    rounds.
    """
    spark = edges.sparkSession
    edges = stage(edges.select("target", "source").distinct(), "lineage-edges")
    inner = edges.select(F.col("target").alias("source")).distinct()
    longest = edges.select("target").distinct().count()
    ends = match_keys(edges, inner, "source", "left_anti", nulls_match=False)
    found = stage(ends.select("target", F.col("source").alias("root")), "lineage-roots")
    # a null source is none that could be built from others
    jumps = stage(match_keys(edges, inner, "source", "left_semi", nulls_match=False).select("target", F.col("source").alias("mid")), "lineage-jumps")
    steps = 1
    while steps < longest and not jumps.isEmpty():
        known = found.select(F.col("target").alias("mid"), "root")
        found = stage(found.unionByName(jumps.join(known, "mid").select("target", "root")).distinct(), "lineage-roots")
        onward = jumps.select(F.col("target").alias("mid"), F.col("mid").alias("_next"))
        jumps = stage(jumps.join(onward, "mid").select("target", F.col("_next").alias("mid")).distinct(), "lineage-jumps")
        steps *= 2
    if targets is None:
        return found
    if isinstance(targets, DataFrame):
        wanted = targets.select(F.col(targets.columns[0]).alias("node")).distinct()
    else:
        wanted = spark.createDataFrame([(t,) for t in names(targets)], "node string").distinct()
    return match_keys(found, wanted, "target", "left_semi", "node")
