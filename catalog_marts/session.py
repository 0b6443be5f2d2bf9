"""A Spark session with the settings these jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024**2


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Enough shuffle partitions for about 128 MB each, and at least one per core."""
    return max(cores, -(-input_bytes // PARTITION_BYTES))


def get_session(app: str = "catalog-marts", partitions: int | None = None, **conf) -> SparkSession:
    """Session with adaptive execution (skew splits, coalescing) and fair scheduling.

    ``partitions`` is the starting number of shuffle partitions; adaptive execution merges small
    ones. ``conf`` overrides any setting; master and resources stay with ``spark-submit``.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.scheduler.mode": "FAIR",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
