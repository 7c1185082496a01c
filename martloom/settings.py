"""Session settings the marts run best with at scale."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    # Months and days of zoned timestamps are the same wherever the job runs.
    "spark.sql.session.timeZone": "UTC",
    # Hot join keys are split over several tasks while the job runs.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merge small shuffle partitions up to this size instead of keeping one per core.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Hash instead of sort where each partition of the smaller side is seen to fit.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def apply_settings(spark: SparkSession, keep: Mapping[str, str] | None = None) -> None:
    """Apply each setting that neither the deployer has made nor ``keep`` holds."""
    deployed = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not deployed.contains(key) and key not in (keep or ()):
            spark.conf.set(key, value)
