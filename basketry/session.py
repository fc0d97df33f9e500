"""SparkSession for tests, the benchmark and the batch jobs' CLI.

Library functions never create a session; they take DataFrames.  Settings
here are the ones the operators assume or benefit from: UTC session zone,
AQE with partition coalescing and skew-join splitting, shuffle partitions
sized to the cores, Arrow for pandas hand-offs, and the UI off.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(cores: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "basketry", extra: dict | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS") or "*"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BASKETRY_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_id(spark: SparkSession) -> str:
    """Application id (works for classic and Connect sessions)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
