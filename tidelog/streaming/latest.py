"""The kept table of the latest row per key (T15): a snapshot by buckets, merged with each delta.

Rows are dealt to buckets by their key. A micro-batch rewrites the buckets that its rows
fall in and commits a numbered manifest (bucket -> folder); the others stay as they are.
Readers take the newest manifest: one row per key, nothing to regroup. A micro-batch that
is replayed is known by its number and changes nothing. Folders that a merge replaced are
deleted by the merge after it, so a reader has one round to finish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.sources.stored_log import Folder


class LatestTable:
    """The rows of ``schema`` with the highest ``order_col`` per ``keys``, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order_col: str, schema: str, buckets: int = 32) -> None:
        self.spark, self.path, self.keys, self.order_col, self.buckets = spark, path, keys, order_col, buckets
        self.schema = T.StructType.fromDDL(schema)
        self.manifests = Folder(spark, f"{path}/_manifests")

    def manifest(self) -> dict:
        names = self.manifests.names()
        return self.manifests.read(names[-1]) if names else {"number": -1, "folders": {}, "applied": {}, "replaced": []}

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders]).select(self.schema.names)

    def read(self) -> DataFrame:
        return self._rows(sorted(self.manifest()["folders"].values()))

    def merge(self, delta: DataFrame, query_id: str, batch_id: int) -> None:
        """Take in rows of one micro-batch. Null keys are keys, too; of equal orders one row stays."""
        last = self.manifest()
        if batch_id <= last["applied"].get(query_id, -1):
            return
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        marked = delta.select(self.schema.names).withColumn("_bucket", bucket)
        touched = [str(r[0]) for r in marked.select("_bucket").distinct().collect()]       # at most ``buckets`` numbers
        old = [last["folders"][b] for b in touched if b in last["folders"]]
        other = [c for c in self.schema.names if c not in self.keys]
        merged = self._rows(old).withColumn("_bucket", bucket).unionByName(marked).groupBy(*self.keys, "_bucket") \
            .agg(F.max_by(F.struct(*other), F.col(self.order_col)).alias("_l")).select(*self.keys, "_bucket", "_l.*")
        folder = f"data/merge={uuid.uuid4().hex}"
        merged.write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        new = {"number": last["number"] + 1, "folders": last["folders"] | {b: f"{folder}/_bucket={b}" for b in touched},
               "applied": last["applied"] | {query_id: batch_id}, "replaced": old}
        if not self.manifests.create(f"{new['number']:012d}.json", new):
            return self.merge(delta, query_id, batch_id)       # another writer was first
        for gone in last["replaced"]:
            self.manifests.fs.delete(self.manifests.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{gone}"), True)
