"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Every join strategy is left to Spark's own size checks: a side is broadcast only when
# its size, estimated before or measured during the run, is below the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with adaptive execution on; `settings` (dots as in Spark) win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
