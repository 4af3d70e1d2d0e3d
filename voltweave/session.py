"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution is relied on: it merges small shuffle partitions, turns joins into
# broadcast joins from measured sizes and splits skewed join partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "voltweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword options use ``__`` where the key has a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
