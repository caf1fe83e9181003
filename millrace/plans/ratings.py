"""Rating consolidation: six fact tables to one table of current ratings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import match_keys
from millrace.functions.constants import OPEN_END_FAR, OPEN_END_FAR_TS
from millrace.operators.joins import effective_join
from millrace.operators.sets import union_many
from millrace.operators.windows import min_over

# role of the organization that owns a sale or maturity
OWNER_ROLE = 129
# record type of the tranche-to-deal rows, and deal states that do not count
DEAL_RECORD = "DEAL_POOL_TRANCHE"
DEAD_DEAL_STATES = ("151242", "151245")

OUTPUT = (
    "ORG_ID", "INSTR_ID", "RATFR_ID", "UNIQ_RATG_ID", "ENTITY_TYPE_CD", "DEAL_ID", "RATG_TXT", "RATG_DTM",
    "INIT_RATG_DTM", "RATG_CLASS_CD", "PUBL_INDC", "MNTR_INDC", "RATG_OFFC_ID", "RATG_OFFC_NM",
    "EVAL_SHORT_DESC_TXT", "EVAL_DESC_TXT",
)


@dataclass(frozen=True)
class RatingSource:
    """How one fact table finds the organization it belongs to.

    ``owner``: ``dimension`` (issuer of the entity's dimension row),
    ``organization`` (entity-organization row with the owner role) or ``self``.
    ``term`` is the column that ends the dimension row's validity.
    ``end_from_deal`` joins the dimension only where an open deal was found and
    does not look at the dimension's own end.
    """

    entity: str
    fact_id: str
    owner: str = "dimension"
    term: str = "TERM_DTM"
    open_end: str = OPEN_END_FAR_TS
    deals: bool = False
    end_from_deal: bool = False


# fixed values: the six sources, all in the instrument's form
SOURCES = {
    "instrument": RatingSource("INSTRUMENT", "INSTRUMENT_ID"),
    "program": RatingSource("PROGRAM", "PROGRAM_ID"),
    "sale": RatingSource("SALE", "SALE_ID", owner="organization"),
    "organization": RatingSource("ORGANIZATION", "ORGANIZATION_ID", owner="self"),
    "tranche": RatingSource("TRANCHE", "TRANCHE_ID", deals=True),
    "maturity": RatingSource("MATURITY", "MATURITY_ID", owner="organization"),
}

# fixed values: forms of their own that three sources may be asked for
OWN_FORMS = {
    "organization": replace(SOURCES["organization"], open_end="9999-12-31 12:00:00"),
    "tranche": replace(SOURCES["tranche"], end_from_deal=True),
    "maturity": replace(SOURCES["maturity"], term="EFFT_DTM"),
}


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def current_ratings(
    source: RatingSource,
    facts: DataFrame,
    classes: DataFrame,
    as_of: dt.datetime,
    dimension: DataFrame | None = None,
    bridge: DataFrame | None = None,
    deals: DataFrame | None = None,
) -> DataFrame:
    """Distinct current ratings of one fact table in the common 16 columns."""
    year_start = dt.date(as_of.year, 1, 1)
    key = source.fact_id
    live = facts.filter(
        (F.col("EFFT_DTM").cast("date") < F.lit(year_start))
        & (F.col("END_DTM").cast("timestamp_ntz") == _ntz(source.open_end))
    )
    # the joins below repeat whole (entity, object, class) groups and never drop
    # part of one, so the first rating date can be taken from the facts alone
    live = min_over(live, [key, "RATING_OBJECT_ID", "RATING_CLASS_CD"], "RATING_DTM", "INIT_RATG_DTM")
    live = live.select(*[c for c in live.columns if c not in ("EFFT_DTM", "END_DTM", "DEAL_ID")])
    rows = match_keys(live, classes, "RATING_CLASS_CD", "left", nulls_match=False)

    deal = F.lit(None).cast("bigint")
    if source.deals:
        links = bridge.filter(F.col("RECORD_TYPE_CD") == DEAL_RECORD).select(
            F.col("TRANCHE_ID").alias("_entity"), "DEAL_ID"
        )
        open_deals = deals.filter(
            (F.col("END_DTM").cast("date") == F.lit(OPEN_END_FAR)) & ~F.col("STATUS_CD").isin(*DEAD_DEAL_STATES)
        ).select(F.col("DEAL_ID").alias("_deal"))
        rows = rows.join(links, rows[key] == links["_entity"], "left").drop("_entity")
        rows = rows.join(open_deals, rows["DEAL_ID"] == open_deals["_deal"], "left")
        deal = F.col("DEAL_ID").cast("bigint")

    if source.owner == "self":
        rows = rows.withColumn("ORG_ID", F.col(key))
    elif source.owner == "organization":
        owners = dimension.filter(F.col("ORGANIZATION_ROLE_CD") == OWNER_ROLE)
        owners = owners.withColumnRenamed("ORGANIZATION_ID", "ORG_ID")
        rows = effective_join(rows, owners, key, "ENTITY_ID", as_of, term=source.term, take=["ORG_ID", "ORGANIZATION_ROLE_CD"])
        rows = rows.filter(F.col("ORGANIZATION_ROLE_CD").isNotNull())
    else:
        issuers = dimension.withColumnRenamed("ISSUER_NUM", "ORG_ID")
        if source.end_from_deal:
            issuers = issuers.withColumn("END_DTM", F.lit(OPEN_END_FAR))
        rows = effective_join(rows, issuers, key, key, as_of, term=source.term, take=["ORG_ID"])
        if source.end_from_deal:
            rows = rows.withColumn("ORG_ID", F.when(F.col("_deal").isNotNull(), F.col("ORG_ID")))

    text = lambda c: F.col(c).cast("string")
    return rows.select(
        "ORG_ID",
        F.col(key).alias("INSTR_ID"),
        F.col("RATING_OBJECT_ID").alias("RATFR_ID"),
        # null when any part is null
        F.concat(text("ORG_ID"), F.lit("D"), text(key), F.lit("R"), text("RATING_OBJECT_ID")).alias("UNIQ_RATG_ID"),
        F.lit(source.entity).alias("ENTITY_TYPE_CD"),
        deal.alias("DEAL_ID"),
        F.col("RATING_TXT").alias("RATG_TXT"),
        F.col("RATING_DTM").alias("RATG_DTM"),
        "INIT_RATG_DTM",
        F.col("RATING_CLASS_CD").alias("RATG_CLASS_CD"),
        F.col("PUBLISH_IND").alias("PUBL_INDC"),
        F.col("MONITOR_IND").alias("MNTR_INDC"),
        F.col("RATING_OFFICE_ID").alias("RATG_OFFC_ID"),
        F.col("RATING_OFFICE_NM").alias("RATG_OFFC_NM"),
        F.col("EVALUATION_TYPE_SHORT_DESC").alias("EVAL_SHORT_DESC_TXT"),
        F.col("EVALUATION_TYPE_DESC").alias("EVAL_DESC_TXT"),
    ).distinct()


def consolidate(parts: Sequence[DataFrame], as_of: dt.datetime) -> DataFrame:
    """All sources in one table with the load date."""
    return union_many(list(parts), F.lit(as_of.date()))


def consolidate_all(inputs: Mapping[str, Mapping], classes: DataFrame, as_of: dt.datetime) -> DataFrame:
    """``inputs``: source name -> keyword frames of ``current_ratings``."""
    parts = [current_ratings(SOURCES[n], classes=classes, as_of=as_of, **frames) for n, frames in inputs.items()]
    return consolidate(parts, as_of)
