"""A Spark session with the settings the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(app: str = "masterlint", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
