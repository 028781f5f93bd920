"""Q2 / Q3: publish with retry rounds.

The driver runs one Spark job per round over a shrinking set of pending
events; each round's outcomes are checkpointed into the shared checkpoint
folder (``spark.checkpoint.dir``), so a lost executor never recomputes
earlier rounds and the lineage stays one round deep. The only driver-side
value per round is one boolean ("anything left to retry?"). Waits between
rounds are a column (``delay_ms``), not a sleep.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas as S
from tidelog.functions.columns import backoff_delay_ms
from tidelog.operators import publish as PUB
from tidelog.sources.tables import cut_lineage


def publish_rounds(events: DataFrame, registry: DataFrame, payload_schema: T.StructType,
                   write_failed: Callable[[int], Column], max_retries: int = S.BACKOFF_MAX_RETRIES,
                   whole_batch: bool = False) -> DataFrame:
    """All rounds' outcomes: ``event_id, eid, round, publishing_status, step, detail, delay_ms``.

    Q2 (default): after a round, P15 splits the responses; J1 keeps the
    events to retry (plus every event without an id). Validation failures
    are never retried. The loop stops when nothing with an id is retryable
    (ours: the reference sends the rest once more) or when the retry count
    exceeds ``max_retries`` -- so 5 means 6 retries, 7 attempts.
    Q3 (``whole_batch``): every not-submitted round resends all events.
    """
    pending = events
    outs: list[DataFrame] = []
    rnd = 0
    while True:
        out = PUB.publish_once(pending, registry, payload_schema, F.current_timestamp(), write_failed(rnd))
        out = cut_lineage(out.select(
            "event_id", "eid", F.lit(rnd).cast("bigint").alias("round"), "publishing_status", "step", "detail",
            F.round(backoff_delay_ms(F.lit(rnd)), 3).alias("delay_ms")))
        outs.append(out)
        if whole_batch:
            again = out.filter(PUB.not_submitted(F.col("publishing_status")))
        else:
            again = out.filter(PUB.needs_retry(F.col("publishing_status"), F.col("step")) & F.col("eid").isNotNull())
        if rnd >= max_retries + 1 or again.isEmpty():
            break
        pending = pending if whole_batch else cut_lineage(
            PUB.events_to_retry(pending, out.select("eid", "publishing_status", "step")))
        rnd += 1
    allr = outs[0]
    for o in outs[1:]:
        allr = allr.unionByName(o)
    return allr


def publish_with_retry(events: DataFrame, registry: DataFrame, payload_schema: T.StructType,
                       write_failed: Callable[[int], Column], max_retries: int = S.BACKOFF_MAX_RETRIES,
                       whole_batch: bool = False) -> DataFrame:
    """Per event: attempts, first round it was submitted, final status."""
    r = publish_rounds(events, registry, payload_schema, write_failed, max_retries, whole_batch)
    return r.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.min(F.when(F.col("publishing_status") == "submitted", F.col("round"))).alias("first_submitted_round"),
        F.max_by("publishing_status", "round").alias("final_status"),
    )
