"""Table access and the dimension-size guard used before every broadcast."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A dimension is broadcast when its rows, as JSON text, take at most so many bytes.
BROADCAST_MAX_BYTES = 32 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a scale-factor directory (pruning and filters push down)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def broadcast_if_bounded(dim: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast a dimension only when its measured size is within ``max_bytes``.

    One job sums the bytes of its rows as JSON text; beyond the bound the join
    keeps its shuffle. Hand in dimensions the caller holds or stores (registry,
    ACL, deleted types). Tables derived from the log would run twice here: leave
    those to adaptive execution, which measures them at runtime.
    """
    size = dim.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()["b"] or 0
    return F.broadcast(dim) if size <= max_bytes else dim


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is read, never overridden, and must be there. Only
    a local master without it (tests) gets one under the system temp folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidelog-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_log(log: DataFrame, path: str, mode: str = "append") -> None:
    """Store a log table partitioned by ``event_type`` (scans of one type
    prune the rest) and sorted by (partition, offset) inside each file."""
    log.repartition("event_type", "partition").sortWithinPartitions("partition", "offset") \
        .write.mode(mode).partitionBy("event_type").parquet(path)


def read_log(spark: SparkSession, path: str, event_types: list[str] | None = None) -> DataFrame:
    """Read a stored log; a type filter becomes partition pruning."""
    df = spark.read.parquet(path)
    return df.filter(F.col("event_type").isin(event_types)) if event_types else df
