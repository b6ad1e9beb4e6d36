"""A session with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "framequarry", **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew-join splitting; further settings by keyword with dots written as double underscores."""
    b = SparkSession.builder.appName(app)
    base = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in {**base, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()
