"""Session settings used by the bench, the tests and the smoke entry."""

from __future__ import annotations

from pyspark.sql import SparkSession

# SQL settings that hold on a laptop and on a cluster alike. Memory, master
# and shuffle width belong to the deployment and are left to spark-submit.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(name: str = "touchline", master: str | None = None, **extra: str) -> SparkSession:
    """Return a session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
