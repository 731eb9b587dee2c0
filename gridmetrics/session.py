"""Session set-up."""

from __future__ import annotations

from pyspark.sql import SparkSession


def energy_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """A session whose wall clock is UTC, the zone the event times are recorded in.

    Splits may grow to 512 MB. Spark still divides smaller inputs over all cores; on a very large
    one this keeps the number of tasks, and of the shuffle blocks the driver tracks for them, a
    quarter of what the default gives. Shuffle width is left to adaptive execution and the cluster.
    ``conf`` overrides any of these.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "512m",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
