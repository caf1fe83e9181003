"""Fee satellites, the rating cross-walk and annual exchange rates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import row_hash
from millrace.operators.cdc import satellite_append, with_hash_keys
from millrace.operators.joins import crosswalk
from millrace.operators.sets import sort_rows

# fixed values: content of the fee satellite and its column order
FEE_ATTRIBUTES = ("EFFT_DT", "FEE_DESC", "FEE_ID", "FEE_ID_TYPE", "REGL_FEE_CLASS", "REGL_FEE_TYPE")
FEE_COLUMNS = (
    "FEE_HUB_HASH", "REGL_FEE_TYPE", "REGL_FEE_CLASS", "FEE_DESC", "EFFT_DT", "DIFF_HASH", "SRC_SYS_CD", "LOAD_DTM",
    "FEE_ID", "FEE_ID_TYPE",
)
SCHEDULE_ATTRIBUTES = ("regl_fee_schd_nm", "regl_fee_prgm")


def fee_satellite(origins: Sequence[DataFrame], legacy_hash: bool = False) -> DataFrame:
    """Distinct rows of every origin with hub and diff hash, in one sorted table."""
    hashed = [
        with_hash_keys(df.distinct(), "FEE_ID", FEE_ATTRIBUTES, "FEE_HUB_HASH", "DIFF_HASH", legacy_hash).select(*FEE_COLUMNS)
        for df in origins
    ]
    return sort_rows(reduce(DataFrame.union, hashed), "FEE_ID")


def fee_schedule(source: DataFrame, target: DataFrame | None, load_dtm: dt.datetime, legacy_hash: bool = False) -> DataFrame:
    """Insert-only fee schedule per invoice line."""
    rows = source.withColumn("diff_hash", row_hash(list(SCHEDULE_ATTRIBUTES), legacy=legacy_hash, separator=","))
    rows = rows.withColumn("load_dtm", F.lit(load_dtm.strftime("%Y-%m-%d %H:%M:%S")))
    return satellite_append(target, rows, "invc_line_dtl_id", SCHEDULE_ATTRIBUTES)


def rating_crosswalk(origins: Sequence[DataFrame], lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(invoice aggregate without the rating id, line-to-rating cross-walk)."""
    rows = reduce(DataFrame.union, origins)
    aggregate = rows.drop("RATIFER_ID").distinct()
    pairs = rows.select("invc_line_dtl_id", "RATIFER_ID", "load_dt")
    linked = crosswalk(pairs, lookup, "RATIFER_ID", "ratifer_num", "rating_identifier")
    links = linked.select(
        "invc_line_dtl_id", F.col("RATIFER_ID").alias("RATFR_ID"), F.col("rating_identifier").alias("ratg_id"), "load_dt"
    )
    return aggregate, links


def _rates(df: DataFrame, year, rate: str, origin: str, target: str, load_dt: dt.date) -> DataFrame:
    return df.select(
        year.cast("bigint").alias("rpt_year"),
        F.lit(origin).alias("cury_from_nm"),
        F.lit(target).alias("cury_to_nm"),
        F.col(rate).try_cast("double").alias("avg_year_xcgh_rate"),
        F.lit(load_dt).alias("load_dt"),
    )


def exchange_rates(
    euro: Mapping[str, DataFrame],
    pound: DataFrame,
    load_dt: dt.date,
    period: str = "period",
    value: str = "value",
    date: str = "date",
) -> DataFrame:
    """Annual averages in one shape.

    ``euro`` holds one series per currency with a year text, ``pound`` the
    dollar series with a date.  Rows whose period is no year (page headings)
    are not rates.
    """
    parts = []
    for currency, df in euro.items():
        year = F.col(period).cast("string").try_cast("bigint")
        parts.append(_rates(df.filter(year.isNotNull()), year, value, "EUR", currency, load_dt))
    parts.append(_rates(pound, F.year(F.col(date).cast("date")), value, "GBP", "USD", load_dt))
    return reduce(DataFrame.union, parts)
