"""Session settings. The caller owns the session, its master and its memory."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings the operators are tuned for; every one can be overridden.
PROFILE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The JVM interprets methods above 8,000 bytes; beyond that, smaller
    # generated projections are several times faster than one large loop.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.network.timeout": "800s",
    "spark.executor.heartbeatInterval": "120s",
    "spark.python.worker.reuse": "true",
}


def with_profile(
    builder: SparkSession.Builder,
    shuffle_partitions: int = 200,
    driver_memory: str = "8g",
    executor_memory: str = "8g",
    max_result_size: str = "4g",
    jdbc_jar: str | None = None,
    **overrides: str,
) -> SparkSession.Builder:
    """Add the profile to a builder; ``overrides`` use ``__`` for dots."""
    settings = dict(PROFILE)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings["spark.driver.memory"] = driver_memory
    settings["spark.executor.memory"] = executor_memory
    settings["spark.driver.maxResultSize"] = max_result_size
    if jdbc_jar:
        settings["spark.jars"] = jdbc_jar
    settings.update({k.replace("__", "."): v for k, v in overrides.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder


def tune(spark: SparkSession) -> SparkSession:
    """Give a running session the SQL settings of the profile it has not set."""
    for key, value in PROFILE.items():
        if key.startswith("spark.sql.") and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark
