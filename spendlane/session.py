"""Spark session settings for the report.

On a cluster the session comes from the platform; :func:`tune` only sets what
the report relies on (AQE with skew-join splitting, UTC).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# static: only settable when the session is created
STATIC_CONF = {
    # call-site capture costs several py4j round trips per Column built; the
    # report builds hundreds of Columns per plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

REPORT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# a skewed join is split also where what follows would then need a shuffle: the report sums up
# its lines where they lie by client, and only a run in which a client is skewed pays for one
SPLIT_ALWAYS = "spark.sql.adaptive.forceOptimizeSkewedJoin"


def tune(spark: SparkSession, split_always: bool = False) -> SparkSession:
    for k, v in (REPORT_CONF | {SPLIT_ALWAYS: str(split_always).lower()}).items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "spendlane") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPENDLANE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**STATIC_CONF, **REPORT_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
