"""Session settings the pipelines are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution measures each shuffle before it picks the join: a side below the broadcast
# threshold is broadcast, a skewed partition of a sort-merge join is split. Python call-site
# capture is only of use while debugging and makes building long column lists slow.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configured(builder: SparkSession.Builder, **extra: str) -> SparkSession.Builder:
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder
