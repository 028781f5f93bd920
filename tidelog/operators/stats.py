"""Log statistics (A8-A10). Two-level aggregates with map-side combine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog import schemas as S


def traffic_statistics(log: DataFrame, ts_col: str = "ts", raw_col: str = "raw") -> DataFrame:
    """Per event type: average messages per active minute, average message
    size in bytes, and the active minutes."""
    per_min = log.groupBy("event_type", F.date_trunc("minute", F.col(ts_col)).alias("_minute")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length(raw_col)).alias("_bytes"))
    return per_min.groupBy("event_type").agg(
        F.round(F.avg("_n"), 6).alias("messages_per_minute"),
        F.round(F.sum("_bytes") / F.sum("_n"), 6).alias("message_size"),
        F.count(F.lit(1)).alias("active_minutes"),
    )


def trace_counts(events: DataFrame, span_ctx_col: str = "metadata.span_ctx") -> DataFrame:
    """Events per trace id of the span context (events without one skipped)."""
    tid = F.element_at(F.col(span_ctx_col), F.lit(S.TRACE_ID_KEY))
    return events.select(tid.alias("trace_id")).filter(F.col("trace_id").isNotNull()) \
        .groupBy("trace_id").agg(F.count(F.lit(1)).alias("events"))


def partition_counts(log: DataFrame) -> DataFrame:
    """A10: events per (event_type, partition) and the share of the type."""
    c = log.groupBy("event_type", "partition").agg(F.count(F.lit(1)).alias("events"))
    return c
