"""Session settings used by the tests, the benchmark and stand-alone runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with a UTC clock and adaptive execution.

    ``spark.sql.shuffle.partitions`` is left to the cluster; adaptive execution
    coalesces small shuffle partitions and splits skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a skewed join input even when that costs one more shuffle downstream
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
