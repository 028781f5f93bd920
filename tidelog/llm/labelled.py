"""Bounded samples of labelled texts for the trained operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, max_rows: int,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``text`` and ``label`` (0/1) of at most ``max_rows`` labelled rows.

    ``usable`` is a condition on the label table's id column (which rows may be
    learnt from). The rows are those with the smallest hash of their id, so the
    sample is the same on every run; rows without id, label or text are left
    out, and of several labels of one id the largest counts. The label side has
    at most ``max_rows`` narrow rows and is broadcast on that bound.
    """
    picked = labels.filter(usable & F.col(label).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label).cast("int")).alias("label")) \
        .orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")) \
        .filter(F.col("text").isNotNull())
    return texts.join(F.broadcast(picked), "__id").select("__id", "text", "label")
