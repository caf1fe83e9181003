"""Operator 3 [native]: judge urls by host and path rules with a sort-merge range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import packed, unpacked
from millrace.scratch import stage

OUTPUTS = ("host", "path", "rule", "verdict")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def host_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def host_key(host: Column) -> Column:
    """Reversed labels, each followed by a dot: a host's subdomains are the keys that start with its own."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(host_labels(host), "."), F.lit(".")))


def rule_events(rules: DataFrame) -> DataFrame:
    """(key, stack): the rules active from each key on, where an interval of hosts starts or ends.

    A rule host with the key ``k.`` covers ``[k., k/)``, as ``/`` follows ``.``
    in byte order.  Such intervals nest, so the stack at a start is the host
    with its ancestors, and that at an end is the ancestors alone.
    """
    host = F.translate(F.coalesce(F.col("host"), F.lit("")), UPPER, LOWER)
    path = F.coalesce(F.col("path"), F.lit(""))
    verdict = F.coalesce(F.col("action"), F.lit("block"))
    entry = F.struct(
        F.length(F.concat(host, path)).alias("long"), F.length(host).alias("deep"), verdict.alias("verdict"),
        F.concat(host, path).alias("rule"), path.alias("path"),
    )
    hosts = rules.select(host.alias("host"), host_key(host).alias("key"), entry.alias("entry"))
    entries = hosts.groupBy("key", "host").agg(F.collect_set("entry").alias("entries"))
    labels = host_labels(F.col("host"))
    chain = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit("."))
    )
    above = F.array_union(F.array(F.lit("")), F.when(F.col("host") == "", F.array(F.lit(""))).otherwise(chain))
    pairs = entries.select(F.col("key").alias("own"), F.explode(above).alias("key")).join(entries.drop("host"), "key")

    def stacks(rows: DataFrame) -> DataFrame:
        return rows.groupBy("own").agg(F.flatten(F.collect_list("entries")).alias("stack"))

    starts = stacks(pairs).select(F.col("own").alias("key"), "stack")
    parents = stacks(pairs.where(F.col("key") != F.col("own")))
    ends = entries.where(F.col("key") != "").select(F.col("key").alias("own")).join(parents, "own", "left")
    none = F.slice(F.array(F.struct(
        F.lit(0).alias("long"), F.lit(0).alias("deep"), F.lit("").alias("verdict"), F.lit("").alias("rule"), F.lit("").alias("path")
    )), 1, 0)
    after = F.concat(F.expr("substring(own, 1, length(own) - 1)"), F.lit("/"))
    return starts.unionByName(ends.select(after.alias("key"), F.coalesce("stack", none).alias("stack")))


def judge_urls(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict.

    ``rules`` holds (host, path, action).  A rule fits its host and all
    subdomains if the url's path starts with the rule's; the one with the most
    characters wins, then the deeper host, then block.  Null hosts and paths of
    rules are empty (an empty host fits all), a null action blocks.  A null url
    or one without ``://`` has an empty host and path.  Without rules every
    verdict is ``default``.  Columns named like an output are replaced.

    Rule events and urls are sorted together by key in range buckets; a sweep
    carries the stack of active rules from each event to the urls behind it.  A
    number per row spreads a hot host over buckets, as every bucket takes over
    the stack of those before it.  Pass only the columns needed: they travel
    through two exchanges.
    """
    host, path = url_host(F.col(f"`{url}`")), url_path(F.col(f"`{url}`"))
    events = rule_events(rules).select(
        "key", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("place"), "stack", F.lit(True).alias("is_event")
    )
    rows = pages.select(packed(pages), host.alias("host"), path.alias("path")).select(
        host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), F.monotonically_increasing_id().alias("place"),
        "host", "path", "row", F.lit(False).alias("is_event"),
    )
    sorted_rows = rows.unionByName(events, allowMissingColumns=True).repartitionByRange("key", "kind", "place")
    swept = stage(sorted_rows.withColumn("bucket", F.spark_partition_id()), "url-sweep")

    last = F.max_by("stack", F.when(F.col("is_event"), F.col("key")))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        swept.groupBy("bucket").agg(last.alias("stack"))
        .select(F.col("bucket").alias("_bucket"), F.last("stack", True).over(earlier).alias("carried"))
    )
    so_far = Window.partitionBy("bucket").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    active = swept.withColumn("active", F.last("stack", True).over(so_far)).where(~F.col("is_event"))
    active = active.join(carried, F.col("bucket") == F.col("_bucket"))
    fitting = F.filter(F.coalesce("active", "carried"), lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(fitting)
    return active.select("row", "host", "path", best.alias("best")).select(
        *unpacked(pages.columns, OUTPUTS), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
