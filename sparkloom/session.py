"""The session that the engine runs in, where the caller brings none."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "sparkloom", **conf: str) -> SparkSession:
    """Adaptive plans, UTC and Arrow; the master and sizes are the cluster's to name."""
    builder = SparkSession.builder.appName(name)
    defaults = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
