"""Operator 9: remove repeated lines and sentences by hashing text units across all documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import packed
from millrace.scratch import stage

#: Units tile the text: paragraphs end at empty lines, lines at line feeds, sentences also after . ! and ?.
UNITS = {
    "paragraph": r"(?:[^\n]+\n?)+|\n",
    "line": r"[^\n]+\n?|\n",
    "sentence": r"[^\n.!?]+[.!?]*\n?|[.!?]+\n?|\n",
}


def normal_unit(unit: str) -> tuple[bytes, int]:
    """A-Z in lower case, words joined by single spaces; and the number of words."""
    words = unit.encode().lower().split()
    return b" ".join(words), len(words)


def text_units(text: str, pattern: re.Pattern, least_words: int) -> list[tuple[int, int, int, int, int]]:
    """(start, end, words, two halves of a 128-bit digest) of the units long enough; offsets in code points."""
    found = []
    for match in pattern.finditer(text):
        normal, words = normal_unit(match.group())
        if words >= least_words:
            digest = xxhash.xxh3_128_intdigest(normal)
            found.append((match.start(), match.end(), words, (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)))
    return found


def text_runs(text: str, pattern: re.Pattern, least_words: int) -> list[tuple[int, int, int, int, int]]:
    """The units of :func:`text_units`, and shorter ones joined with their neighbours.

    From every short unit on, and back from it, the next units are joined until
    they have ``least_words``, a long one too: so the ends of a passage count as
    well.  Units without words are passed over.
    """
    units = [(m.start(), m.end(), *normal_unit(m.group())) for m in pattern.finditer(text)]
    units, found = [u for u in units if u[3]], []
    chosen = set()
    for k, (_, _, _, words) in enumerate(units):
        for step in (1, -1):
            last, held = k, words
            while held < least_words and 0 <= last + step < len(units):
                last += step
                held += units[last][3]
            if held >= least_words:
                chosen.add((min(k, last), max(k, last)))
    for first, last in sorted(chosen):
        run = units[first: last + 1]
        digest = xxhash.xxh3_128_intdigest(b" ".join(u[2] for u in run))
        halves = (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)
        found.append((run[0][0], run[-1][1], sum(u[3] for u in run), *halves))
    return found


def unit_occurrences(
    docs: DataFrame, identity: Column, text: Column, unit: str, least_words: int, at: Column | None, runs: bool = False
) -> DataFrame:
    """Stored (id, at, begins, ends, words, high, low), one row per unit; ``at`` is unique per document row."""
    names, pattern = ["begins", "ends", "words", "high", "low"], re.compile(UNITS[unit])
    cut_text = text_runs if runs else text_units

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for first in range(0, len(texts), 256):
                rows, owner = [], []
                for k in range(first, min(first + 256, len(texts))):
                    units = cut_text(texts[k].as_py() or "", pattern, least_words)
                    rows += units
                    owner += [k] * len(units)
                if rows:
                    own = pa.array(owner, pa.int32())
                    columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), *columns], names=["id", "at", *names])

    at = F.monotonically_increasing_id() if at is None else at
    chosen = docs.select(identity.alias("id"), at.alias("at"), text.alias("text"))
    schema = T.StructType(chosen.schema.fields[:2] + [T.StructField(n, T.LongType()) for n in names])
    return stage(chosen.mapInArrow(cut, schema), "units")


def repeated_units(
    docs: DataFrame, *, identity: Column, text: Column, unit: str = "line", least_words: int = 8, at: Column | None = None,
    runs: bool = False,
) -> DataFrame:
    """(id, at, begins, ends, words, first_id, first_begins): every unit to remove, with the occurrence that stays.

    Units of ``least_words`` words or more are equal if their words are, A-Z
    lower-cased.  The earliest occurrence by (id, offset) stays, null ids last;
    of repeated rows one keeps it.  Offsets are code points of the whole text,
    ``ends`` exclusive.  Texts that are null, empty or without long units have
    no rows; so has an empty table.  With ``runs`` the shorter units are joined
    with their neighbours as in :func:`text_runs`; rows may overlap then, and a
    run equals any unit or run of the same words.

    Digests that occur once are dropped by a count first; only the others are
    joined back, by a key that adaptive execution can split.
    """
    units = unit_occurrences(docs, identity, text, unit, least_words, at, runs)
    again = units.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = stage(again.select(F.col("high").alias("_high"), F.col("low").alias("_low")), "units-repeated")
    known = (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low"))
    found = stage(units.join(again, known).drop("_high", "_low"), "units-occurrences")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "begins", "at")
    firsts = found.groupBy(F.col("high").alias("_high"), F.col("low").alias("_low")).agg(F.min(rank).alias("first"))
    # stored, so that a hot digest can be split in the join
    later = found.join(stage(firsts, "units-firsts"), known).where((F.col("at") != F.col("first.at")) | (F.col("begins") != F.col("first.begins")))
    return later.select(
        "id", "at", "begins", "ends", "words", F.col("first.id").alias("first_id"), F.col("first.begins").alias("first_begins")
    )


def remove_units(docs: DataFrame, *, identity: str, text: str, unit: str = "line", least_words: int = 8, runs: bool = True) -> DataFrame:
    """``docs`` with repeated units, and runs of short ones, cut out of ``text`` and ``removed``: the merged spans, in offsets of the original text.

    A column named removed is replaced.
    """
    rows = stage(docs.select(packed(docs), F.monotonically_increasing_id().alias("number")), "units-rows")
    own = F.col("row").getField
    later = repeated_units(rows, identity=own(identity), text=own(text), unit=unit, least_words=least_words, at=F.col("number"), runs=runs)
    span = F.struct("begins", "ends")
    spans = later.groupBy(F.col("at").alias("_number")).agg(F.array_sort(F.collect_list(span)).alias("removed"))
    kind = spans.schema["removed"].dataType
    merge = F.udf(lambda found: merged(found), kind)
    spans = spans.withColumn("removed", merge("removed"))
    joined = rows.join(spans, F.col("number") == F.col("_number"), "left")
    cut = F.pandas_udf(lambda texts, found: pd.Series([cut_spans(t, s) for t, s in zip(texts, found)], dtype=object), "string")
    joined = joined.withColumn("clean", cut(own(text), F.col("removed")))
    empty = F.coalesce("removed", F.slice(F.array(F.struct(F.lit(0).cast("bigint").alias("begins"), F.lit(0).cast("bigint").alias("ends"))), 1, 0))
    columns = [F.col("clean").alias(c) if c == text else own(c).alias(c) for c in docs.columns if c.lower() != "removed"]
    return joined.select(*columns, empty.alias("removed"))


def merged(spans) -> list[tuple[int, int]]:
    """Sorted spans with overlapping ones put together; spans that only touch stay apart."""
    out = []
    for begins, ends in spans:
        if out and begins < out[-1][1]:
            out[-1] = (out[-1][0], max(ends, out[-1][1]))
        else:
            out.append((begins, ends))
    return out


def cut_spans(text: str | None, spans) -> str | None:
    """The text without the spans."""
    if text is None or spans is None or not len(spans):
        return text
    kept, at = [], 0
    for span in spans:
        kept.append(text[at: span["begins"]])
        at = span["ends"]
    return "".join(kept) + text[at:]
