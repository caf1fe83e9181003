"""Corpus pipeline: the stages by which documents become training shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import fmindex, langid, mixing, sharding, simhash
from millrace.llm.common import packed, word_count

#: SQL cannot say language models, XXH64 fingerprints or the seeded shuffle; tests compare with plain versions.
ORACLE_SQL = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_check(docs: DataFrame):
    """Hash of a row's columns, by which decisions find rows without an id, too."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, longer where the table has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; those rejected go.  Few are, so they are what is joined."""
    check, gone_id, gone_check = (free_name(docs, n) for n in ("_check", "_gone_id", "_gone_check"))
    marked = docs.withColumn(check, row_check(docs))
    found = langid.identify_documents(marked, table(spark, sf_dir, "pages"), carried=(check,))
    gone = found.where("NOT kept").select(F.col("doc_id").alias(gone_id), F.col(check).alias(gone_check)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.col(check) == F.col(gone_check))
    return marked.join(gone, same, "left_anti").drop(check)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-copies: five-word shingles with a Jaccard similarity of 0.8 or more."""
    return simhash.drop_similar(docs, identity="doc_id", text="text", shingle=5, least=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans they share with benchmark items; n_chars follows the text."""
    cut = fmindex.decontaminate(docs, table(spark, sf_dir, "benchmark"), text="text")
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their targets; documents are repeated or left out as the mix says."""
    rows = docs.select(packed(docs))
    own = F.col("row").getField
    mixed = mixing.mix_sources(rows, None, size=word_count(own("text")), identity=own("doc_id"), source=own("source"))
    return mixing.repeat_rows(mixed).select(*[own(c).alias(c) for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of equal counts, uniformly shuffled."""
    return sharding.shard_rows(docs, 8)


STAGES = [
    ("language id", identify_language),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
