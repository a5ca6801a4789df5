"""Session settings the jobs rely on; a cluster's own values win where it has set them."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # a task writes the few quarters it holds side by side instead of sorting all its rows first
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    # methods above this size are never compiled by the JVM; wide projections are cut up instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # recording a call site for every column expression costs more than building the plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reqlytics")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
