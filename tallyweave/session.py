"""Session settings shared by tests and the benchmark. On a cluster, pass your own session instead."""

from __future__ import annotations

from pyspark.sql import SparkSession

# For a cluster: let Spark size shuffle partitions from measured data. Start from many small ones
# (about three per core), merge them up to the advisory size, split what is skewed, and read
# files in pieces of the same size, so that a task's share fits in memory at any data volume.
# The JVM never compiles methods over 8,000 bytes, so generated code beyond that is better split
# than fused; this matters for projections that read many JSON paths.
# Set ``spark.checkpoint.dir`` besides, to a folder that driver and executors share: intermediate tables go there.
SPLIT_LARGE_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}
CLUSTER_SETTINGS = {
    **SPLIT_LARGE_METHODS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.scheduler.mode": "FAIR",  # entities that are ingested side by side share the cluster
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", app: str = "tallyweave", **conf: str) -> SparkSession:
    settings = {
        **SPLIT_LARGE_METHODS,
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
