"""Session helpers.

A cluster hands us a configured session; we only fill in settings that are
unset, so a cluster's own `spark.sql.shuffle.partitions` and AQE thresholds
always win.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on. Applied with `setdefault` semantics.
DEFAULT_CONF = {
    # Runtime re-planning: coalesces small shuffle partitions, splits skewed
    # join partitions, and turns a sort-merge join into a broadcast join only
    # when the measured size of one side is under the broadcast threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Dates are calendar dates; no zone shift anywhere.
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULT_CONF where the session has no value yet."""
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "revops_spark") -> SparkSession:
    """A local session for tests and the bench (no UI, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("REVOPS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        # batch use: no per-call call-site capture while plans are built
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
