"""Rule verification from stored states: a new partition is measured once, old ones are not read again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import fs
from millrace.operators import quality
from millrace.operators.quality import Rule


@dataclass(frozen=True)
class Part:
    """One stored measure of a rule: how rows give it and how stored ones are put together."""

    name: str
    measure: Column
    merge: Callable[[str], Column]


def parts_of(rule: Rule, kind: T.DataType) -> list[Part]:
    """The measures of a rule; ``isUnique`` has none, as a value may repeat in any other partition."""
    value = quality._value(rule.column)
    if rule.name == "isUnique":
        raise ValueError(f"{rule.text} needs all rows at once")
    if rule.name == "hasApproxCountDistinct":
        return [Part("hll", F.hll_sketch_agg(value), F.hll_union_agg)]
    if rule.name == "hasApproxQuantile":
        return [Part("kll", F.kll_sketch_agg_double(value.cast("double")), F.kll_merge_agg_double)]
    if rule.name in ("hasMin", "isNonNegative", "isPositive", "hasMax"):
        numbers = value.try_cast("double") if isinstance(kind, T.StringType) else value
        function = F.max if rule.name == "hasMax" else F.min
        return [Part("bound", function(numbers), function)]
    hit, base, _ = quality.share_of(rule)
    return [Part("hits", F.count(F.when(base & hit, F.lit(1))), F.sum), Part("total", F.count(F.when(base, F.lit(1))), F.sum)]


def outcome(rule: Rule, kind: T.DataType, found: Callable[[str], Column]) -> tuple[Column, Column]:
    """(metric as text, passed) from the merged measures."""
    if rule.name == "hasApproxCountDistinct":
        count = F.hll_sketch_estimate(found("hll"))
        low, high = rule.arguments
        return count.cast("string"), (count >= low) & (count <= high)
    if rule.name == "hasApproxQuantile":
        share, low, high = rule.arguments
        value = F.kll_sketch_get_quantile_double(found("kll"), F.lit(float(share)))
        return value.cast("decimal(18,6)").cast("string"), F.coalesce((value >= low) & (value <= high), F.lit(True))
    if rule.name in ("hasMin", "isNonNegative", "isPositive", "hasMax"):
        return quality.judge_bound(rule, kind, found("bound"))
    hits, total = F.coalesce(found("hits"), F.lit(0)), F.coalesce(found("total"), F.lit(0))
    return quality._share(hits, total), quality._least(hits, total, quality.share_of(rule)[2])


def state_name(rule: Rule, part: str) -> str:
    """Column of a stored state: it follows from the rule alone, so rules may come and go."""
    return f"{rule.name}_{hashlib.md5(f'{rule.column}:{rule.text}'.encode()).hexdigest()[:12]}_{part}"


def measure(df: DataFrame, rules: Iterable[Rule], by: str | None = None) -> DataFrame:
    """One row of states, or one per value of ``by``, from a single pass over ``df``."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    measures = {}
    for rule in rules:
        for part in parts_of(rule, kinds[rule.column]):
            measures[state_name(rule, part.name)] = part.measure
    grouped = df.groupBy(quality._value(by)) if by else df.groupBy()
    return grouped.agg(*[m.alias(n) for n, m in measures.items()])


def store_states(states: DataFrame, path: str, partition: str) -> None:
    """Keep the states of one partition; a repeated run replaces them."""
    states.write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={partition}")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The stored states of all partitions; rules that came later have nulls in earlier ones."""
    return spark.read.option("mergeSchema", True).option("basePath", path).parquet(path)


def stored_partitions(spark: SparkSession, path: str) -> list[str]:
    return [n[len("part="):] for n in fs.children(spark, path) if n.startswith("part=")]


def verify_states(states: DataFrame, rules: Iterable[Rule], schema: T.StructType) -> DataFrame:
    """The result rows of ``quality.verify`` over all rows that ``states`` stand for.

    ``schema`` is that of the measured rows.  A rule that some state does not
    hold stops the job: it was not measured there.
    """
    rules, kinds = list(rules), {f.name: f.dataType for f in schema.fields}
    merged, marks = [], []
    for rule in rules:
        for part in parts_of(rule, kinds[rule.column]):
            name = state_name(rule, part.name)
            if name not in states.columns:
                raise ValueError(f"{rule.text} was never measured")
            merged.append(part.merge(F.col(name)).alias(name))
            if part.name != "bound":  # the bound of a partition without values is null
                marks.append(F.count(F.col(name)).alias(f"_n_{name}"))
    one = states.agg(F.count(F.lit(1)).alias("_states"), *merged, *marks)
    rows = []
    for rule in rules:
        kind = kinds[rule.column]
        metric, passed = outcome(rule, kind, lambda part, rule=rule: F.col(state_name(rule, part)))
        unmeasured = F.raise_error(F.lit(f"{rule.text} was not measured in every partition")).cast("boolean")
        complete = F.lit(True)
        for part in parts_of(rule, kind):
            if part.name != "bound":
                complete = complete & (F.col(f"_n_{state_name(rule, part.name)}") == F.col("_states"))
        rows.append(quality._result(rule, metric, F.when(complete, passed).otherwise(unmeasured)))
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
