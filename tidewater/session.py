"""Spark session settings shared by tests, the bench and the driver entry.

On a cluster the session already exists and carries the operator's
settings; ``configure`` only fills in what is missing.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Settings every query in the library relies on.  Timestamps in the test
# tables are TIMESTAMP_NTZ; UTC keeps any LTZ conversion an identity.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let AQE split skewed shuffle partitions of aggregations as well.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

#: Most bytes of a task's input, of a scan's split and of shuffled rows.  To join and aggregate a shuffled,
#: compressed byte takes some 40 bytes of memory, so Spark's own 128 and 64 MB take gigabytes.
TASK_BOUNDS = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20}
_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tidewater", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SQL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply SQL defaults that the session does not already set, and lower what a task reads to the bounds
    above (never raise it)."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    for key, most in TASK_BOUNDS.items():
        now = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", spark.conf.get(key).strip().lower())
        if now is None or int(now[1]) << _UNITS[now[2]] > most:
            spark.conf.set(key, str(most))
    return spark


def spread(spark: SparkSession, n_bytes: int) -> None:
    """Raise the number of shuffle partitions (never lower it) so that ``n_bytes`` of input make partitions
    within the bound; adaptive execution joins small ones but splits none of an aggregation."""
    key = "spark.sql.shuffle.partitions"
    n = -(-n_bytes // TASK_BOUNDS["spark.sql.adaptive.advisoryPartitionSizeInBytes"])
    if int(spark.conf.get(key)) < n:
        spark.conf.set(key, str(n))
