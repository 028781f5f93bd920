"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when its measured size is at most this.
BROADCAST_MAX_BYTES = 32 << 20
# Rows of one Arrow batch of texts.
TEXTS_PER_BATCH = 1_000
# An Arrow batch ends with the row that brings it to so many bytes.
BYTES_PER_BATCH = 1 << 19
# Rows that a parquet reader decodes at a time (Spark's 4,096 long texts are arrays of many MB).
ROWS_PER_READ = 1_024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor directory, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local master (tests) gets a fresh temporary folder;
    on a cluster that is an error, as executors would not see such a folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tidelog-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder of its own below the shared folder."""
    return os.path.join(shared_dir(spark), f"llm-{uuid.uuid4().hex}", name)


def stored(df: DataFrame, name: str, *cluster_by: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that were running.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    out = df.repartition(*cluster_by) if cluster_by else df
    out.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Work tables of one operator in a folder of their own below the shared folder.

    ``drop`` deletes tables that nothing reads any more, ``close`` the folder.
    Results must not read a table that is gone: store them elsewhere first.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self.paths = spark, work_dir(spark, name), {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """As ``stored``, in this folder."""
        path = os.path.join(self.root, f"{len(self.paths)}-{name}")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table_ in tables:
            _delete(self.spark, self.paths[id(table_)][0])

    def close(self) -> None:
        _delete(self.spark, self.root)


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on whichever file system holds it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def broadcast_if_small(df: DataFrame, n_bytes: Column, limit: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast of ``df`` only when the sum of ``n_bytes`` over its rows
    is within ``limit``; otherwise the join stays a shuffle join. Costs one job
    over ``df``, so hand in a stored table."""
    total = df.agg(F.sum(n_bytes).alias("b")).first()["b"] or 0
    return F.broadcast(df) if total <= limit else df


def small_batches(spark: SparkSession) -> None:
    """Send whole texts to Python workers in batches of ``TEXTS_PER_BATCH`` rows and
    ``BYTES_PER_BATCH`` bytes, read by ``ROWS_PER_READ`` (Spark's default of 10,000 rows
    of long texts fills a small executor)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(ROWS_PER_READ))


def give_back() -> None:
    """Free memory that this process's allocators hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def lean(run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A mapInPandas function whose worker gives its memory back when a task ends.

    Spark keeps workers for later tasks, also through stages without Python, and
    with them what they once took.
    """

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


class Kept:
    """Columns that a Python worker hands on unchanged.

    pandas makes floats of whole numbers beside a null, and nulls of NaN; so numbers
    go through it as text and come back as what they were.
    """

    def __init__(self, df: DataFrame, keep: list[str]) -> None:
        self.fields = df.select(*[F.col(c) for c in keep]).schema.fields
        self.sent = [F.col(f.name).cast("string").alias(f.name) if self._number(f) else F.col(f.name) for f in self.fields]

    @staticmethod
    def _number(field: T.StructField) -> bool:
        return isinstance(field.dataType, (T.IntegralType, T.FloatType, T.DoubleType))

    def schema(self, made: str) -> T.StructType:
        """What the worker returns: these columns, and those that it makes (as DDL)."""
        own = [T.StructField(f.name, T.StringType() if self._number(f) else f.dataType) for f in self.fields]
        return T.StructType(own + T.StructType.fromDDL(made).fields)

    def back(self, df: DataFrame) -> DataFrame:
        """The worker's rows with these columns in their own types."""
        own = [F.col(f.name).cast(f.dataType).alias(f.name) if self._number(f) else F.col(f.name) for f in self.fields]
        return df.select(*own, *df.columns[len(own):])


def id_bucket(col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null: null)."""
    return F.crc32(col.cast("string")) % F.lit(modulus)
