"""File sources."""

from __future__ import annotations

import csv
import re
import xml.etree.ElementTree as ElementTree
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import fs

# candidate field separators of delimited text
SEPARATORS = ",;|\t"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sniff(lines: Iterable[str]) -> tuple[str, bool]:
    """(separator, has header) of sample lines."""
    sample = "\n".join(lines)
    return csv.Sniffer().sniff(sample, SEPARATORS).delimiter, csv.Sniffer().has_header(sample)


def sniff_files(spark: SparkSession, path: str, sample_lines: int, head_bytes: int = 1 << 16) -> tuple[str, bool]:
    """(separator, has header) on which the first ``sample_lines`` lines of every file agree; else an error.

    Only the first ``head_bytes`` of each file are read, whatever its size; a last
    line that is cut there does not count, unless it is the only one.
    """

    def detect(file: str) -> tuple[str, bool] | None:
        text = fs.head(spark, file, head_bytes + 1)
        lines = text[:head_bytes].decode("utf-8", "replace").splitlines()
        if len(text) > head_bytes and len(lines) > 1:
            lines.pop()
        return sniff(lines[:sample_lines]) if lines else None

    files = fs.files(spark, path)
    with ThreadPoolExecutor(16) as pool:
        found = {f for f in pool.map(detect, files) if f is not None}
    if len(found) != 1:
        raise ValueError(f"files of {path} differ in separator or header, or there are none: {sorted(found)}")
    return found.pop()


def read_delimited(
    spark: SparkSession, path: str, sep: str | None = None, header: bool | None = None, schema: T.StructType | str | None = None,
    sample_lines: int = 50, corrupt: str | None = None,
) -> DataFrame:
    """Delimited text.

    Separator and header, unless given, are detected from the first
    ``sample_lines`` lines of every file; files that disagree are refused.
    ``corrupt`` names a text column for whole lines that do not fit the schema,
    which has to be given then; their values stay null where they do not fit.
    Without a schema the types are inferred over all rows, which reads the data
    once more.
    """
    if sep is None or header is None:
        found_sep, found_header = sniff_files(spark, path, sample_lines)
        sep = found_sep if sep is None else sep
        header = found_header if header is None else header
    reader = spark.read.option("sep", sep).option("header", header)
    if corrupt:
        if schema is None:
            raise ValueError("corrupt lines need a schema to be told by")
        known = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*known.fields, T.StructField(corrupt, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def read_headerless(spark: SparkSession, path: str, columns: Iterable[Mapping], sep: str = "|") -> DataFrame:
    """Header-less text (a glob is fine) named by the column records in sequence
    order; every column is text."""
    ordered = sorted(columns, key=lambda r: int(r["sequence_number"]))
    schema = T.StructType([T.StructField(r["source_column_name"], T.StringType()) for r in ordered])
    return spark.read.schema(schema).option("sep", sep).option("header", False).csv(path)


def xml_tags(spark: SparkSession, path: str) -> tuple[str, str]:
    """(root tag, row tag) of all files, every child of the roots looked at; one kind of row only.

    A file is parsed in one task; of files above 2 GB the tag must be named.
    """

    def tags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                parser, depth, root, rows, data = ElementTree.XMLPullParser(["start", "end"]), 0, None, set(), content.as_buffer()
                for at in range(0, data.size, 1 << 20):
                    parser.feed(data.slice(at, min(1 << 20, data.size - at)).to_pybytes())
                    for event, element in parser.read_events():
                        if event == "end":
                            depth -= 1
                            if depth == 1:
                                element.clear()
                            continue
                        if depth == 0:
                            root = element.tag
                        elif depth == 1:
                            rows.add(element.tag)
                        depth += 1
                found = sorted(rows) or [None]
                yield pa.RecordBatch.from_arrays([pa.array([root] * len(found), pa.string()), pa.array(found, pa.string())], names=["root", "row"])

    files = spark.read.format("binaryFile").load(path).select("content")
    found = files.mapInArrow(tags, "root string, row string").distinct().limit(20).collect()
    rows = sorted({r["row"] for r in found if r["row"]})
    if len(rows) != 1 or len({r["root"] for r in found}) != 1:
        raise ValueError(f"expected one row tag below one root, found {rows}")
    return found[0]["root"], rows[0]


def read_xml(
    spark: SparkSession, path: str, row_tag: str | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    """Rows of XML files; without ``row_tag`` all files are searched for the one kind of row first."""
    tag = row_tag or xml_tags(spark, path)[1]
    reader = spark.read.option("rowTag", tag)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.xml(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return spark.read.schema(schema).json(path) if schema is not None else spark.read.json(path)


#: Words of a variant's schema that a column cannot have as they are.
_VARIANT_WORDS = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}


def variant_columns(schema: str) -> str | None:
    """The schema of a JSON object as column types; None for anything but an object.

    Whole numbers stay, other numbers are doubles; what is null throughout or has
    several types is text.  Names in back quotes are left as they are.
    """
    pieces = re.split(r"(`(?:[^`]|``)*`)", schema)
    for k in range(0, len(pieces), 2):
        # a type follows ": " or "<", a name ends with ":"
        typed = re.sub(r"\b(OBJECT|VARIANT|VOID)\b(?!:)", lambda m: _VARIANT_WORDS[m[1]], pieces[k])
        pieces[k] = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", typed)
    found = "".join(pieces)
    return found if found.startswith("STRUCT<") and found != "STRUCT<>" else None


def json_records(df: DataFrame, column: str, schema: T.StructType | str | None = None, corrupt: str | None = None) -> DataFrame:
    """Columns of a JSON text column.

    Without a schema one pass over the texts finds it: each is parsed once and the
    types are put together by an aggregate, so that no field goes unseen and
    nothing is written.  Fields of conflicting types become text.  ``corrupt`` names
    a column for texts that are no JSON; without it they give nulls.
    """
    if schema is None:
        parsed = F.try_parse_json(F.col(f"`{column}`"))
        schema = variant_columns(df.agg(F.schema_of_variant_agg(parsed)).first()[0])
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    text = F.col(f"`{column}`")
    bad = [F.when(text.isNotNull() & F.try_parse_json(text).isNull(), text).alias(corrupt)] if corrupt else []
    if schema is None:
        return df.select(*rest, *bad)
    return df.select(*rest, F.from_json(text, schema).alias("_json"), *bad).select(*rest, "_json.*", *([corrupt] if corrupt else []))


def read_excel(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """Needs a third-party spreadsheet data source on the class path."""
    return (
        spark.read.format("com.crealytics.spark.excel")
        .option("useHeader", True)
        .option("inferSchema", True)
        .option("dataAddress", f"{sheet}!A1")
        .load(path)
    )


def read_any(spark: SparkSession, path: str, columns: Sequence[Mapping] = (), sheet: str | None = None) -> DataFrame:
    """Choose the reader by file extension; no extension means Parquet."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    kind = name.rsplit(".", 1)[-1] if "." in name else "parquet"
    if kind == "parquet":
        return read_parquet(spark, path)
    if kind in ("csv", "txt"):
        return read_delimited(spark, path)
    if kind.upper() == "PIP":
        return read_headerless(spark, path, columns)
    if kind == "xml":
        return read_xml(spark, path)
    if kind == "json":
        return read_json(spark, path)
    if kind == "xlsx":
        return read_excel(spark, path, sheet or "Sheet1")
    raise ValueError(f"unsupported file type: {kind}")
