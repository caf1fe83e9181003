"""Operator 6: quality rules with cross-document line frequency."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import packed
from millrace.scratch import stage

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
DIGITS = re.compile("[0-9]+")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OUTPUTS = (*COUNTS, "base_failed", "removed_words", "kept")


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit values."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ x >> np.uint64(31)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight that occur twice or more, the first occurrence included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = mixed(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64))
    windows = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + codes[k: k + n]
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    starts = order[np.r_[same, False] | np.r_[False, same]]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(change)))


def line_code(line: str) -> int:
    """Hash of a line in lower case, with single spaces and runs of digits as 0."""
    normal = DIGITS.sub("0", " ".join(line.lower().split()))
    return xxhash.xxh64_intdigest(normal.encode()) - (1 << 63)


def text_facts(text: str) -> tuple:
    """The five counts; hash and words of every distinct line that has a word."""
    words = text.encode().split()
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen = Counter(line for line in text.split("\n") if line.strip(SPACES))
    lines: dict[int, int] = {}
    for line, times in seen.items():
        code = line_code(line)
        lines[code] = lines.get(code, 0) + times * len(line.encode().split())
    doubles = sum(seen.values()) - len(seen)
    return len(words), chars, symbols, doubles, repeated_words(words), list(lines), list(lines.values())


def document_facts(docs: DataFrame, text: Column, host: Column, identity: Column, at: Column | None = None) -> DataFrame:
    """Stored (at, doc, host, counts, lines, line_words), one row per row; ``at`` is unique (a running number by default)."""
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
    names = ["at", "doc", "host", *COUNTS, "lines", "line_words"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts = [text_facts(t.as_py() or "") for t in batch.column(3)]
            found = [pa.array([f[k] for f in facts], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(3)] + found, names=names)

    at = F.monotonically_increasing_id() if at is None else at
    chosen = docs.select(at.alias("at"), identity.alias("doc"), host.alias("host"), text.alias("text"))
    found = [T.StructField(n, T.LongType()) for n in COUNTS]
    found += [T.StructField(n, T.ArrayType(T.LongType())) for n in names[-2:]]
    return stage(chosen.mapInArrow(compute, T.StructType(chosen.schema.fields[:3] + found)), "line-facts")


def frequent_lines(facts: DataFrame, least_docs: int, host_share: float) -> DataFrame:
    """(host, line) of normalised lines in more than max(``least_docs``, ``host_share`` of the host's documents) documents.

    A document counts once, also if its row is repeated.  The distinct count
    deals a hot line by document before it meets.
    """
    name = F.coalesce(F.col("doc").cast("string"), F.concat(F.lit("row "), F.col("at").cast("string")))
    lines = facts.select("host", name.alias("doc"), F.explode("lines").alias("line"))
    counts = lines.groupBy("host", "line").agg(F.countDistinct("doc").alias("n")).where(F.col("n") > least_docs)
    hosts = facts.select(F.col("host").alias("_host"), name.alias("doc")).groupBy("_host").agg(F.countDistinct("doc").alias("docs"))
    over = counts.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
    over = over.where(F.col("n") > F.lit(host_share) * F.col("docs")).select("host", "line")
    return stage(over, "line-frequent")


def frequent_by_row(facts: DataFrame, frequent: DataFrame) -> DataFrame:
    """(at, removed_words, removed): what each document loses."""
    pairs = facts.select("at", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("pair"))
    lines = pairs.select("at", "host", F.col("pair.lines").alias("line"), F.col("pair.line_words").alias("words"))
    known = frequent.select(F.col("host").alias("_host"), F.col("line").alias("_line"))
    hit = lines.join(known, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
    return hit.groupBy("at").agg(F.sum("words").alias("removed_words"), F.collect_list("line").alias("removed"))


def judge_documents(
    facts: DataFrame, *, least_docs: int = 20, host_share: float = 0.001, least_words: int = 20, least_share: float = 0.3
) -> DataFrame:
    """``facts`` with base_failed, removed_words, removed (line hashes) and kept.

    base_failed: fewer than 20 words, or over 30 % of the words in windows of
    eight that repeat.  Depleted, and not kept, is a document whose frequent lines
    leave fewer than ``least_words`` words or less than ``least_share`` of its
    words.  A null text has no words; null hosts are one host; a row without an
    id is a document of its own; repeated rows are one document, each judged.
    """
    losses = frequent_by_row(facts, frequent_lines(facts, least_docs, host_share)).withColumnRenamed("at", "_at")
    joined = facts.drop("lines", "line_words").join(losses, F.col("at") == F.col("_at"), "left").drop("_at")
    removed = F.coalesce("removed_words", F.lit(0).cast("bigint"))
    left = F.col("n_words") - removed
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return joined.withColumns({
        "removed_words": removed, "base_failed": failed,
        "kept": ~failed & (left >= least_words) & (left >= F.lit(least_share) * F.col("n_words")),
    })


def clean_documents(docs: DataFrame, *, text: str, host: str, identity: str, **limits) -> DataFrame:
    """``docs`` with the frequent lines cut out of ``text``, and the columns ``OUTPUTS`` (replaced if they exist).

    The rows are stored once with a number, by which the decisions come back.
    """
    rows = stage(docs.select(packed(docs), F.monotonically_increasing_id().alias("number")), "line-rows")
    own = [F.col("row").getField(c) for c in (text, host, identity)]
    judged = judge_documents(document_facts(rows, *own, F.col("number")), **limits)
    joined = rows.join(judged.select("at", *OUTPUTS, "removed"), F.col("number") == F.col("at"))
    cut = F.pandas_udf(lambda texts, lines: pd.Series([cut_lines(t, r) for t, r in zip(texts, lines)], dtype=object), "string")
    cleaned = joined.withColumn("clean", cut(F.col("row").getField(text), F.col("removed")))
    columns = [F.col("clean").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in OUTPUTS]
    return cleaned.select(*columns, *OUTPUTS)


def cut_lines(text: str | None, removed: list[int] | None) -> str | None:
    """The text without lines whose hash is in ``removed``."""
    if not text or removed is None or not len(removed):
        return text
    gone = set(removed)
    return "\n".join(line for line in text.split("\n") if not line.strip(SPACES) or line_code(line) not in gone)
