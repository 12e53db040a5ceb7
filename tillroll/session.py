"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "tillroll", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution.

    No broadcast hint is set on data of unknown size anywhere in the library:
    Spark broadcasts what its own size statistics show to be below
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges the rest, where
    adaptive execution splits skewed partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
