"""Stateful streaming operators.

* ``flush_batches`` (T14): a partition's pending events leave as a batch when
  ``batch_limit`` is reached or ``batch_flush_timeout`` passes -- a custom
  stateful operator, so it is ``applyInPandasWithState`` with a processing
  time timeout. State per (event_type, partition) holds fewer than
  ``batch_limit`` pending events, never more.
* ``streaming_latest`` (T15): A7 compaction / A3 last cursor kept current
  with ``max_by`` in update mode (partial aggregation, bounded state: one
  row per key).
* ``streaming_traffic`` (T16): A8 per tumbling minute with a watermark; event
  time must be TIMESTAMP (``withWatermark`` rejects TIMESTAMP_NTZ).
* ``expired_stream`` (J5): batches whose commit did not come in time, by an
  interval join of two streams.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidelog import schemas as S
from tidelog.functions.columns import offset_num

FLUSH_OUT = "event_type string, partition string, batch_no long, first_offset long, last_offset long, " \
            "n_events long, reason string"
FLUSH_STATE = "pending_offsets array<long>, batches long"


def flush_batches(events: DataFrame, batch_limit: int, flush_timeout_s: int) -> DataFrame:
    """T14 over a stream of ``(event_type, partition, offset)`` rows."""
    limit = max(int(batch_limit), 1)
    timeout_ms = int(flush_timeout_s * 1000)

    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        et, part = key
        if state.exists:
            pending, n_batches = list(state.get[0] or []), int(state.get[1])
        else:
            pending, n_batches = [], 0
        out = []
        if state.hasTimedOut:
            if pending:
                out.append((et, part, n_batches, pending[0], pending[-1], len(pending), "timeout"))
                n_batches += 1
            pending = []
        else:
            for pdf in pdfs:
                pending.extend(int(x) for x in pdf["offset"].tolist())
            pending.sort()
            full = len(pending) - len(pending) % limit
            for first in range(0, full, limit):
                chunk = pending[first:first + limit]
                out.append((et, part, n_batches, chunk[0], chunk[-1], len(chunk), "limit"))
                n_batches += 1
            pending = pending[full:]
        state.update((pending, n_batches))
        if pending:
            state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(out, columns=["event_type", "partition", "batch_no", "first_offset", "last_offset",
                                         "n_events", "reason"])

    return events.select("event_type", "partition", F.col("offset").cast("long").alias("offset")) \
        .groupBy("event_type", "partition").applyInPandasWithState(
            step, FLUSH_OUT, FLUSH_STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def streaming_latest(events: DataFrame, keys: list[str], order_col: str, value_cols: list[str]) -> DataFrame:
    """Latest row per key (compaction) as a continuously updated table."""
    return events.groupBy(*keys).agg(
        F.max_by(F.struct(*value_cols), F.col(order_col)).alias("_l"), F.max(order_col).alias(order_col)) \
        .select(*keys, order_col, "_l.*")


def streaming_traffic(events: DataFrame, ts_col: str = "ts", watermark: str = "10 minutes") -> DataFrame:
    """Events per type and tumbling minute, late data bounded by the watermark."""
    t = F.col(ts_col).cast("timestamp")
    return events.withColumn("_et", t).withWatermark("_et", watermark) \
        .groupBy("event_type", F.window("_et", "1 minute").alias("minute")) \
        .agg(F.count(F.lit(1)).alias("events"))


def expired_stream(sent: DataFrame, commits: DataFrame, commit_timeout_s: int = 0, watermark: str = "0 seconds") -> DataFrame:
    """J5 on a stream: batches without a covering commit within the timeout, once that is certain.

    A left outer join of two streams in the interval of the timeout: a commit covers a
    batch of its log partition when its offset is not below the batch's and it comes
    between sending and deadline. State holds one timeout (and the watermark's delay) of
    batches and commits; a batch comes out when the watermarks have passed its deadline.
    Time is cut into slots as long as the timeout, which are part of the join's key: a
    batch stands in its slot, a commit in its own and the one before, so a batch is
    compared with the commits of two slots, not with all of its log partition.
    ``sent``: event_type, partition, batch_no, offset, sent_ts; ``commits``: event_type,
    partition, offset, commit_ts. Rows later than the watermark are not seen.
    """
    seconds = int(commit_timeout_s or S.DEFAULT_COMMIT_TIMEOUT_S)
    timeout = F.expr(f"INTERVAL {seconds} SECONDS")

    def slot(ts: str) -> Column:
        return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("long")

    b = sent.withColumn("sent_ts", F.col("sent_ts").cast("timestamp")).withWatermark("sent_ts", watermark) \
        .withColumn("_slot", slot("sent_ts")).alias("b")
    c = commits.withColumn("commit_ts", F.col("commit_ts").cast("timestamp")).withWatermark("commit_ts", watermark) \
        .withColumn("_slot", F.explode(F.array(slot("commit_ts") - 1, slot("commit_ts")))).alias("c")
    covers = (F.col("b.event_type") == F.col("c.event_type")) & (F.col("b.partition") == F.col("c.partition")) \
        & (F.col("b._slot") == F.col("c._slot")) & (offset_num("c.offset") >= offset_num("b.offset")) \
        & (F.col("c.commit_ts") >= F.col("b.sent_ts")) & (F.col("c.commit_ts") <= F.col("b.sent_ts") + timeout)
    return b.join(c, covers, "left_outer").filter(F.col("c.commit_ts").isNull()) \
        .select("b.event_type", "b.partition", "b.batch_no", "b.offset", "b.sent_ts")
