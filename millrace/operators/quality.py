"""Rule verification, rule suggestion and source/target comparison."""

from __future__ import annotations

import ast
import datetime as dt
import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import names
from millrace.functions.types import safe_cast, type_family
from millrace.operators.cdc import unique_rows
from millrace.operators.sets import presence, sample_keys
from millrace.scratch import stage

COUNT = "decimal(20,0)"

# share of distinct values above which a complete column is suggested as unique
UNIQUE_SHARE = 0.92
# relative standard error of the distinct counts of a profile
DISTINCT_ERROR = 0.01
# completeness range in which a lower bound is suggested
COMPLETENESS_FLOOR = 0.2


@dataclass(frozen=True)
class Rule:
    """One named rule on a column, e.g. ``hasMin`` with arguments ``(0,)``."""

    name: str
    column: str
    arguments: tuple = field(default_factory=tuple)
    description: str = ""

    @property
    def text(self) -> str:
        inside = ", ".join([f'"{self.column}"', *[repr(a) for a in self.arguments]])
        return f".{self.name}({inside})"


def parse_rule(text: str, column: str, description: str = "", allow_sql: bool = False) -> Rule:
    """``isComplete()`` or ``hasMin(0)`` -> Rule.

    Only literals are read; an argument list that starts with the column's own
    name may repeat it.  ``satisfies`` holds SQL that Spark will run: it is
    refused unless ``allow_sql`` says that the text is trusted.
    """
    call = ast.parse(text.strip().lstrip("."), mode="eval").body
    if not isinstance(call, ast.Call) or not isinstance(call.func, ast.Name) or call.keywords:
        raise ValueError(f"not a rule: {text!r}")
    if call.func.id not in _CHECKS:
        raise ValueError(f"unknown rule: {call.func.id}")
    if call.func.id == "satisfies" and not allow_sql:
        raise ValueError("satisfies runs SQL; pass allow_sql for trusted texts")
    arguments = tuple(ast.literal_eval(a) for a in call.args)
    if arguments and arguments[0] == column:
        arguments = arguments[1:]
    return Rule(call.func.id, column, arguments, description)


def _share(hits: Column, total: Column) -> Column:
    """``hits / total`` for the message, 1 when there are none; never compared."""
    return F.coalesce(F.try_divide(hits.cast("double"), total), F.lit(1.0)).cast("decimal(18,6)").cast("string")


def _least(hits: Column, total: Column, share: float) -> Column:
    """At least ``share`` of the total, compared by counts; true when there are none."""
    return hits.cast(COUNT) >= F.lit(Decimal(str(share))) * total.cast(COUNT)


def _rated(hit: Column, base: Column, share: float) -> tuple[Column, Column]:
    total = F.count(F.when(base, F.lit(1)))
    hits = F.count(F.when(base & hit, F.lit(1)))
    return _share(hits, total), _least(hits, total, share)


def _value(c: str) -> Column:
    return F.col(f"`{c}`")


def _present(c: str) -> Column:
    return _value(c).isNotNull()


def _bound(function, test, signed: bool = False):
    """Smallest or largest value against a limit, both in the column's own type; texts count as numbers where they are."""

    def build(rule: Rule, kind: T.DataType) -> tuple[Column, Column]:
        value = _value(rule.column)
        return judge(rule, kind, function(value.try_cast("double") if isinstance(kind, T.StringType) else value))

    def judge(rule: Rule, kind: T.DataType, metric: Column) -> tuple[Column, Column]:
        if signed and not isinstance(kind, (*_NUMERIC, T.StringType)):
            raise ValueError(f"{rule.name} needs numbers: {rule.column}")
        limit = F.lit(rule.arguments[0] if rule.arguments else 0)
        if not isinstance(kind, (*_NUMERIC, T.StringType)):
            limit = limit.cast(kind)
        text = metric.cast("string")
        if isinstance(kind, (*_NUMERIC, T.StringType)):
            text = F.coalesce(metric.try_cast("decimal(18,6)").cast("string"), text)
        return text, F.coalesce(test(metric, limit), F.lit(True))

    build.judge = judge
    return build


# rules of the form: at least this share of the non-null values passes
_HITS = {
    "isContainedIn": lambda r: _value(r.column).isin(list(r.arguments[0])),
    "hasPattern": lambda r: _value(r.column).cast("string").rlike(r.arguments[0]),
    "hasDataType": lambda r: safe_cast(_value(r.column).cast("string"), "string", r.arguments[0]).isNotNull(),
}


def share_of(rule: Rule) -> tuple[Column, Column, float]:
    """(hit, base, least share) of a rule on a share of the rows."""
    if rule.name in ("isComplete", "hasCompleteness"):
        return _present(rule.column), F.lit(True), rule.arguments[0] if rule.arguments else 1
    least = rule.arguments[1] if len(rule.arguments) > 1 else 1
    if rule.name == "satisfies":
        return F.coalesce(F.expr(rule.arguments[0]), F.lit(False)), F.lit(True), least
    return F.coalesce(_HITS[rule.name](rule), F.lit(False)), _present(rule.column), least


def judge_bound(rule: Rule, kind: T.DataType, metric: Column) -> tuple[Column, Column]:
    """(metric as text, passed) of a rule on a smallest or largest value."""
    return _CHECKS[rule.name].judge(rule, kind, metric)


def _shared(rule: Rule, kind: T.DataType) -> tuple[Column, Column]:
    return _rated(*share_of(rule))


def _approximate(rule: Rule, kind: T.DataType) -> tuple[Column, Column]:
    """Sketches of one pass, read like stored ones."""
    from millrace.operators import states

    part = states.parts_of(rule, kind)[0]
    return states.outcome(rule, kind, lambda _: part.measure)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# rules whose metric is one aggregate over the rows: rule -> (metric, passed)
_CHECKS = {
    "isComplete": _shared,
    "hasCompleteness": _shared,
    "isNonNegative": _bound(F.min, lambda m, v: m >= 0, signed=True),
    "isPositive": _bound(F.min, lambda m, v: m > 0, signed=True),
    "hasMin": _bound(F.min, lambda m, v: m >= v),
    "hasMax": _bound(F.max, lambda m, v: m <= v),
    "isContainedIn": _shared,
    "hasPattern": _shared,
    "hasDataType": _shared,
    "satisfies": _shared,
    "hasApproxCountDistinct": _approximate,  # lowest and highest estimate, by HyperLogLog
    "hasApproxQuantile": _approximate,  # share, lowest and highest value, by KLL
    "isUnique": None,  # needs a count per value, see _unique_result
}


def _result(rule: Rule, metric: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(rule.column).alias("column_name"),
        F.lit(rule.text).alias("dq_rule"),
        F.lit(rule.description).alias("dq_rule_description"),
        F.lit(f"{rule.name}({rule.column})").alias("constraint"),
        F.when(passed, F.lit("Success")).otherwise(F.lit("Failure")).alias("constraint_status"),
        F.when(passed, F.lit("")).otherwise(F.concat(F.lit("Value: "), metric)).alias("constraint_message"),
    )


def _unique_result(df: DataFrame, rule: Rule) -> DataFrame:
    """Copies are counted per value first; a hot value is one row per task."""
    counts = df.filter(_present(rule.column)).groupBy(_value(rule.column)).agg(F.count(F.lit(1)).alias("_n"))
    once, total = F.count(F.when(F.col("_n") == 1, 1)), F.coalesce(F.sum("_n"), F.lit(0))
    measured = counts.agg(_share(once, total).alias("_metric"), (once == total).alias("_passed"))
    return measured.select(_result(rule, F.col("_metric"), F.col("_passed")).alias("_r")).select("_r.*")


def verify(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One result row per rule.

    Shares are compared as counts, bounds in the column's type: one bad row
    fails a rule, however large the table.  All row-wise rules share a single aggregate over the table; each uniqueness
    rule adds one aggregate that reads its column only.
    """
    rules = list(rules)
    flat = [r for r in rules if r.name != "isUnique"]
    parts = [_unique_result(df, r) for r in rules if r.name == "isUnique"]
    if flat:
        kinds = {f.name: f.dataType for f in df.schema.fields}
        checks = [_CHECKS[r.name](r, kinds[r.column]) for r in flat]
        measured = df.agg(*[m.alias(f"_m{i}") for i, (m, _) in enumerate(checks)], *[p.alias(f"_p{i}") for i, (_, p) in enumerate(checks)])
        rows = [_result(r, F.col(f"_m{i}"), F.col(f"_p{i}")) for i, r in enumerate(flat)]
        parts.insert(0, measured.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*"))
    return reduce(DataFrame.unionByName, parts)


def review(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame | None, DataFrame | None]:
    """(results, suggestions): rules are verified; only a table without any gets
    suggestions instead."""
    rules = list(rules)
    return (verify(df, rules), None) if rules else (None, suggest(df))


def with_run(results: DataFrame, pipeline_id: str, at: dt.datetime) -> DataFrame:
    """Result or suggestion rows as records of one run."""
    return results.select(
        F.lit(f"{pipeline_id}_{at:%Y%m%d%H%M%S%f}").alias("execution_id"),
        F.lit(pipeline_id).alias("pipeline_id"),
        F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz").alias("job_execution_time"),
        "*",
    )


def verify_tables(tables: Mapping[str, tuple[DataFrame, Iterable[Rule]]]) -> DataFrame:
    """Results of several tables with the table name in front."""
    results = [verify(df, rules).select(F.lit(t).alias("table_name"), "*") for t, (df, rules) in tables.items()]
    return reduce(DataFrame.unionByName, results)


def failed_tables(results: DataFrame) -> DataFrame:
    failures = results.filter(F.col("constraint_status") == "Failure")
    return failures.groupBy("table_name").agg(F.count(F.lit(1)).alias("failed_rules"))


# ---------------------------------------------------------------- suggestion

_NARROW = ("bigint", "double", "date", "boolean")


def profile(
    df: DataFrame, columns: Sequence[str] | None = None, distinct: bool = True, frequent: float | None = None
) -> DataFrame:
    """One row per column: counts, numeric range, share of texts that parse as a
    narrower type, approximate number of distinct values.

    With ``frequent`` also the candidates for values that make up at least that
    share of a text column: a sketch of frequent items keeps every such value,
    and some that are less frequent.
    One aggregate over the table, whatever the number of columns.
    """
    chosen = list(columns) if columns is not None else df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    measures: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    rows: list[Column] = []
    for i, c in enumerate(chosen):
        value = _value(c)
        measures.append(F.count(value).alias(f"n{i}"))
        number, text = isinstance(kinds[c], _NUMERIC), isinstance(kinds[c], T.StringType)
        measures.append((F.min(value) if number else F.min(F.lit(None))).cast("double").alias(f"lo{i}"))
        measures.append((F.max(value) if number else F.max(F.lit(None))).cast("double").alias(f"hi{i}"))
        for t in _NARROW:
            hit = F.count(safe_cast(value, "string", t)) if text else F.count(F.lit(None))
            measures.append(hit.alias(f"{t}{i}"))
        if distinct:
            measures.append(F.approx_count_distinct(value, DISTINCT_ERROR).alias(f"d{i}"))
        if frequent is not None:
            # counts are off by at most 3.5 / tracked of the rows, and items are returned from twice that on
            most, tracked = math.ceil(1 / frequent), math.ceil(8 / frequent)
            name = c.replace("`", "``")
            items = F.expr(f"transform(approx_top_k(`{name}`, {most}, {tracked}) FILTER (WHERE `{name}` IS NOT NULL), x -> x.item)")
            measures.append((items if text else F.lit(None).cast("array<string>")).alias(f"f{i}"))
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(kinds[c].simpleString()).alias("data_type"),
                F.col("_rows").alias("rows"),
                F.col(f"n{i}").alias("non_null"),
                F.col(f"lo{i}").alias("min_value"),
                F.col(f"hi{i}").alias("max_value"),
                *[F.col(f"{t}{i}").alias(f"as_{t}") for t in _NARROW],
                *([F.col(f"d{i}").alias("approx_distinct")] if distinct else []),
                *([F.col(f"f{i}").alias("frequent")] if frequent is not None else []),
            )
        )
    return df.agg(*measures).select(F.explode(F.array(*rows)).alias("_p")).select("_p.*")


def suggest(
    df: DataFrame, columns: Sequence[str] | None = None, list_values: int | None = None, list_share: float | None = None,
    least_share: float = 0.005,
) -> DataFrame:
    """Rule suggestions from the profile: column, description and rule text.

    With ``list_values``, a text column of at most that many values, counted
    exactly, also gets the list of them all.  With ``list_share``, a text column of
    which fewer values make up that share, though not all, gets the list of these;
    only values of at least ``least_share`` count as frequent.
    """
    p = profile(df, columns, frequent=least_share if list_share is not None else None)
    if list_share is not None:
        p = stage(p, "profile")  # it is read for the candidates as well
    share = F.try_divide(F.col("non_null").cast("double"), F.col("rows"))
    # lower end of the 95 % interval around the observed share
    spread = F.sqrt(share * (1 - share) / F.col("rows")) * 1.96
    floor = F.floor((share - spread) * 100) / 100
    quoted = F.concat(F.lit('"'), F.col("column_name"), F.lit('"'))
    complete = F.col("non_null") == F.col("rows")

    def rule(when: Column, name: str, extra: Column | None, text: Column) -> Column:
        inside = quoted if extra is None else F.concat(quoted, F.lit(", "), extra)
        code = F.concat(F.lit(f".{name}("), inside, F.lit(")"))
        return F.when(
            when & (F.col("rows") > 0),
            F.struct(F.lit(name).alias("rule"), text.alias("dq_suggestion_result"), code.alias("dq_rule")),
        )

    narrow = F.coalesce(*[F.when(F.col(f"as_{t}") == F.col("non_null"), F.lit(t)) for t in _NARROW])
    of = F.concat(F.lit("'"), F.col("column_name"), F.lit("'"))
    rules = F.array(
        rule(complete, "isComplete", None, F.concat(of, F.lit(" is not null"))),
        rule(
            (share > COMPLETENESS_FLOOR) & (share < 1),
            "hasCompleteness",
            floor.cast("decimal(4,2)").cast("string"),
            F.concat(of, F.lit(" has less than "), F.round((1 - floor) * 100).cast("int").cast("string"), F.lit("% missing values")),
        ),
        rule(F.col("min_value") >= 0, "isNonNegative", None, F.concat(of, F.lit(" has no negative values"))),
        rule(
            (F.col("data_type") == "string") & (F.col("non_null") > 0) & narrow.isNotNull(),
            "hasDataType",
            F.concat(F.lit("'"), narrow, F.lit("'")),
            F.concat(of, F.lit(" has type "), narrow),
        ),
        rule(
            complete & (F.try_divide(F.col("approx_distinct"), F.col("rows")) >= UNIQUE_SHARE),
            "isUnique",
            None,
            F.concat(of, F.lit(" is unique")),
        ),
    )
    found = p.select("column_name", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("_s"))
    found = found.select(F.col("column_name").alias("source_col_name"), "_s.*")
    if list_share is not None:
        found = found.unionByName(_frequent_suggestions(df, p, list_share, least_share))
    return found if list_values is None else found.unionByName(_list_suggestions(df, columns, list_values))


def _frequent_suggestions(df: DataFrame, p: DataFrame, share: float, least: float) -> DataFrame:
    """Lists of the values that together make up ``share`` of a text column, most frequent first.

    Only the candidates of the profile are counted, exactly; the other values of
    the column are neither made distinct nor exchanged.  A column whose frequent
    values do not reach the share gets no list, one that has no others neither.
    """
    candidates = p.where("data_type = 'string'").select(
        F.col("column_name").alias("_name"), F.explode("frequent").alias("_v"), F.col("non_null").alias("_total")
    )
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cells = F.array(*[F.struct(F.lit(c).alias("name"), _value(c).alias("v")) for c in texts]).cast("array<struct<name:string,v:string>>")
    rows = df.select(F.explode(cells).alias("_c")).select("_c.*")
    counted = rows.join(candidates, (F.col("name") == F.col("_name")) & (F.col("v") == F.col("_v")))
    counted = counted.groupBy("name", "v", "_total").agg(F.count(F.lit(1)).alias("n"))
    # a column has at most 1 / least such values
    counted = counted.where(F.col("n").cast(COUNT) >= F.lit(Decimal(str(least))) * F.col("_total").cast(COUNT))
    order = Window.partitionBy("name").orderBy(F.desc("n"), "v").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(order), F.lit(0))
    wanted = F.lit(Decimal(str(share))) * F.col("_total").cast(COUNT)
    chosen = counted.withColumn("before", before).where(F.col("before").cast(COUNT) < wanted)
    listed = chosen.groupBy("name", "_total").agg(
        F.sum("n").alias("covered"), F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "v"))).alias("vs")
    ).where((F.col("covered").cast(COUNT) >= wanted) & (F.col("covered") < F.col("_total")))
    part = F.col("covered").cast("double") / F.col("_total")
    floor = F.floor((part - F.sqrt(part * (1 - part) / F.col("_total")) * 1.96) * 100) / 100
    quoted = F.array_join(F.transform("vs", lambda x: _quoted(x["v"])), ", ")
    text = floor.cast("decimal(4,2)").cast("string")
    return listed.select(
        F.col("name").alias("source_col_name"),
        F.lit("isContainedIn").alias("rule"),
        F.concat(F.lit("'"), "name", F.lit("' has value range "), quoted, F.lit(" for at least "), (floor * 100).cast("int").cast("string"), F.lit("% of values")).alias("dq_suggestion_result"),
        F.concat(F.lit('.isContainedIn("'), "name", F.lit('", ['), quoted, F.lit("], "), text, F.lit(")")).alias("dq_rule"),
    )


def _quoted(value: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("\\'")), F.lit("'"))


def _list_suggestions(df: DataFrame, columns: Sequence[str] | None, most: int) -> DataFrame:
    """Value lists of the text columns that hold ``most`` values at most; one pass counts all columns."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)]
    cells = F.array(*[F.struct(F.lit(c).alias("name"), _value(c).alias("v")) for c in texts]).cast("array<struct<name:string,v:string>>")
    values = df.select(F.explode(cells).alias("_c")).select("_c.*").where("v IS NOT NULL").distinct()
    few = values.groupBy(F.col("name").alias("_few")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= most)
    kept = values.join(few, F.col("name") == F.col("_few"), "left_semi")
    quoted = F.transform(F.sort_array(F.collect_list("v")), _quoted)
    listed = kept.groupBy("name").agg(F.array_join(quoted, ", ").alias("vs"))
    return listed.select(
        F.col("name").alias("source_col_name"),
        F.lit("isContainedIn").alias("rule"),
        F.concat(F.lit("'"), "name", F.lit("' has value range "), "vs").alias("dq_suggestion_result"),
        F.concat(F.lit('.isContainedIn("'), "name", F.lit('", ['), "vs", F.lit("])")).alias("dq_rule"),
    )


# ---------------------------------------------------------------- comparison


def missing_keys(source: DataFrame, target: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that only one side has."""
    keys = names(key)
    seen = presence(source.select(*keys), target.select(*keys)).filter(F.col("_in_left") != F.col("_in_right"))
    return seen.select(*keys, F.when(F.col("_in_left"), F.lit("target")).otherwise(F.lit("source")).alias("missing_in"))


def cell_diff(
    source: DataFrame,
    target: DataFrame,
    key: str | Sequence[str],
    columns: Sequence[str] | None = None,
    sample: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Names of the differing columns for every key both sides have.

    Values compare null-safely.  The key must identify a row on each side (the
    job stops otherwise), so the join never multiplies rows.  With ``sample``,
    at most that many keys are compared, as in a spot check.
    """
    keys = names(key)
    compared = list(columns) if columns is not None else [c for c in source.columns if c not in keys]
    left = unique_rows(source.select(*keys, *compared), keys)
    right = unique_rows(target.select(*keys, *compared), keys)
    joined = left.alias("s").join(right.alias("t"), keys, "inner")
    marks = [F.when(~F.col(f"s.`{c}`").eqNullSafe(F.col(f"t.`{c}`")), F.lit(c)).otherwise(F.lit("")) for c in compared]
    diff = joined.select(
        *keys, *[F.col(f"t.`{c}`").alias(c) for c in compared], F.array_remove(F.array(*marks), "").alias("column_names")
    ).filter(F.size("column_names") > 0)
    if sample is None:
        return diff
    return diff.join(sample_keys(diff, keys, sample, seed), keys, "left_semi")


def type_family_diff(columns: DataFrame, source: str = "source_datatype", target: str = "target_datatype") -> DataFrame:
    """Declared source and target type of each column record, by family."""
    found, wanted = type_family(F.col(source)), type_family(F.col(target))
    return columns.withColumns({"source_family": found, "target_family": wanted, "same_family": found == wanted})
