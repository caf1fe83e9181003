"""Type names carried as text in column records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.constants import NUMBER_TYPES, STRING_TYPES, TYPE_LABELS


def present(value) -> bool:
    return value not in (None, "", "null", "0", 0)


def target_type(name: str, length=None, precision=None) -> str:
    """Spark SQL type of one column record; character lengths do not truncate."""
    base = name.strip().lower()
    if base == "datetime":
        return "timestamp"
    if base in STRING_TYPES:
        return "string"
    if present(length) and precision not in (None, "", "null"):
        return f"{base}({int(length)},{int(precision)})"
    return base


# fixed values: the texts Spark accepts for a type, apart from surrounding blanks
_BLANKS = r"[\x00-\x20]*"
_WHOLE = r"[+-]?\d+"
_NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?"
_FLOAT = r"[+-]?(((\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?)|0x[0-9a-f.]+p[+-]?\d+[df]?|inf(inity)?|nan)"
_FLAG = r"(t|true|y|yes|1|f|false|n|no|0)"
_ACCEPTED = {
    "tinyint": _WHOLE,
    "smallint": _WHOLE,
    "int": _WHOLE,
    "bigint": _WHOLE,
    "decimal": _NUMBER,
    "float": _FLOAT,
    "double": _FLOAT,
    "boolean": _FLAG,
}


def safe_cast(value: Column, source: str, target: str) -> Column:
    """``try_cast`` that tests a text first.

    A failing cast raises and catches an exception for every row, about ten
    times the cost of the test.
    """
    pattern = _ACCEPTED.get(target.split("(")[0].strip().lower()) if source == "string" else None
    if pattern is None:
        return value.try_cast(target)
    return F.when(value.rlike(f"(?i)^{_BLANKS}{pattern}{_BLANKS}$"), value.try_cast(target))


def ddl_type(name: Column, length: Column, precision: Column) -> Column:
    """Column type of a CREATE TABLE statement, as a Column over metadata rows.

    ``datetime`` becomes TIMESTAMP, a ``string`` with a length VARCHAR, a decimal
    without a length gets 38 digits.  Length and precision 0 mean "not given".
    """
    upper = F.upper(name)
    size = F.coalesce(length, F.lit(0))
    scale = F.coalesce(precision, F.lit(0))
    base = (
        F.when(upper == "DATETIME", F.lit("TIMESTAMP"))
        .when((upper == "STRING") & (size != 0), F.lit("VARCHAR"))
        .otherwise(upper)
    )
    digits = F.when(size == 0, F.lit(38)).otherwise(size)
    numeric = base.isin("DECIMAL", "NUMERIC")
    return (
        F.when(numeric, F.format_string("%s(%d,%d)", base, digits, scale))
        .when(base.isin("CHAR", "VARCHAR"), F.format_string("%s(%d)", base, size))
        .otherwise(base)
    )


def type_family(name: Column) -> Column:
    """number, string, or date for everything else."""
    lower = F.lower(name)
    return (
        F.when(lower.isin(*NUMBER_TYPES), F.lit("number"))
        .when(lower.isin(*STRING_TYPES), F.lit("string"))
        .otherwise(F.lit("date"))
    )


def base_type(name: Column) -> Column:
    """``decimal(10,2)`` -> ``decimal``."""
    return F.lower(F.regexp_extract(name, r"^\s*([A-Za-z_0-9 ]*[A-Za-z_0-9])", 1))


def type_label(name: Column, unlabelled: Sequence[str] = ()) -> Column:
    """Catalogue label of a type name; unknown names pass through."""
    labels = {k: v for k, v in TYPE_LABELS.items() if k not in unlabelled}
    return label_by(base_type(name), labels, name)


def label_by(key: Column, labels: Mapping[str, str], default: Column) -> Column:
    result = None
    for value, label in labels.items():
        result = F.when(key == value, F.lit(label)) if result is None else result.when(key == value, F.lit(label))
    return result.otherwise(default)
