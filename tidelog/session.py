"""Local session for tests and the benchmark (a cluster brings its own)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "tidelog") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDELOG_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(total_input_bytes: int, executors: int = 1000, cores_per_executor: int = 4) -> dict[str, str]:
    """Settings we would hand a large cluster for a log of ``total_input_bytes``.

    Shuffle partitions start at ~256 MB of input each (AQE coalesces small
    ones and splits skewed ones at runtime), never fewer than two waves of
    the cluster's cores; scans read 256 MB splits.
    """
    slots = executors * cores_per_executor
    parts = max(2 * slots, total_input_bytes // (256 << 20))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
