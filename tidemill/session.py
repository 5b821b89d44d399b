"""Sessions with the settings the library is tested under."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tidemill", **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution; settings use __ for dots."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in settings.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()
