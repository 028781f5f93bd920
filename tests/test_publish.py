"""Publish outcomes and retry selection."""

from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.operators import publish as PUB
from tidelog.plans import queries as Q
from tidelog.plans.retry import publish_rounds
from tidelog.sources import testdata as td


def test_needs_retry_truth_table(spark):
    rows = [("submitted", "none"), ("failed", "validating"), ("aborted", "none"), ("failed", "publishing"),
            ("aborted", None), ("failed", "enriching")]
    df = spark.createDataFrame(rows, "publishing_status string, step string")
    got = [r.x for r in df.select(PUB.needs_retry(F.col("publishing_status"), F.col("step")).alias("x")).collect()]
    assert got == [False, False, True, True, True, True]


def test_events_to_retry_keeps_idless(spark):
    ev = spark.createDataFrame([
        ("business", {"eid": "11111111-2222-3333-4444-555555555555"}, '{}'),
        ("business", {"eid": "66666666-7777-8888-9999-000000000000"}, '{}'),
        ("undefined", None, '{"x":1}'),
    ], "category string, metadata struct<eid:string>, raw string")
    resp = spark.createDataFrame([
        ("11111111-2222-3333-4444-555555555555", "failed", "publishing"),
        ("66666666-7777-8888-9999-000000000000", "submitted", "none"),
        (None, "aborted", "none"),
    ], "eid string, publishing_status string, step string")
    out = PUB.events_to_retry(ev, resp).collect()
    assert sorted((r.category, r.metadata.eid if r.metadata else None) for r in out) == [
        ("business", "11111111-2222-3333-4444-555555555555"), ("undefined", None)]


def test_batch_all_or_nothing(spark):
    df = spark.createDataFrame([
        ("b1", "v", None, None, "0"), ("b1", None, None, None, "1"), ("b2", None, None, None, "0"),
        ("b2", None, "x", None, "1"), ("b3", None, None, None, "3"),
    ], "batch_id string, validation_error string, enrich_error string, partition_error string, partition string")
    out = PUB.partition_outcome(PUB.batch_outcome(df), F.col("partition") == "3")
    got = sorted((r.batch_id, r.partition, r.publishing_status, r.step) for r in out.collect())
    assert got == [("b1", "0", "failed", "validating"), ("b1", "1", "aborted", "none"),
                   ("b2", "0", "aborted", "none"), ("b2", "1", "failed", "enriching"),
                   ("b3", "3", "failed", "publishing")]


def test_retry_property(spark, sf_small):
    """Every event ends submitted or rejected; validation failures are never retried;
    at most max_retries + 2 attempts."""
    events = Q._publish_input(spark, sf_small)
    rounds = publish_rounds(events, td.registry(spark), S.EVENT_PAYLOAD, Q._write_failed)
    n_in = events.count()
    per = rounds.groupBy("event_id").agg(F.count(F.lit(1)).alias("attempts"),
                                        F.max_by("publishing_status", "round").alias("final"),
                                        F.max(F.when(F.col("step") == "validating", F.col("round"))).alias("v"))
    assert per.count() == n_in
    assert per.filter(F.col("attempts") > S.BACKOFF_MAX_RETRIES + 2).count() == 0
    # a validation failure is final: it happens in the event's last round
    bad = per.filter(F.col("v").isNotNull()).join(
        rounds.groupBy("event_id").agg(F.max("round").alias("last")), "event_id")
    assert bad.filter(F.col("v") != F.col("last")).count() == 0
    # delays compound
    d = {r["round"]: r.delay_ms for r in rounds.select("round", "delay_ms").distinct().collect()}
    assert d[0] == 100.0 and d[1] == 150.0


def test_read_outcomes(spark):
    body = ('[{"eid":"11111111-2222-3333-4444-555555555555","publishing_status":"failed","step":"validating",'
            '"detail":"bad"},{"publishing_status":"submitted","step":"none"},{"publishing_status":"lost"}]')
    df = spark.createDataFrame([(1, body)], "call int, body string")
    out = sorted(PUB.read_outcomes(df).collect(), key=lambda r: r.item_no)
    assert [r.publishing_status for r in out] == ["failed", "submitted", "lost"]
    assert out[0].item_error is None and out[1].eid is None
    assert out[2].item_error == "$.publishing_status: not one of submitted,failed,aborted"


def test_whole_batch_retry(spark, sf_small):
    """Q3: every round resends everything until a round has no failure."""
    events = Q._publish_input(spark, sf_small).filter(F.col("event_type") == "click")
    rounds = publish_rounds(events, td.registry(spark), S.EVENT_PAYLOAD, Q._write_failed, whole_batch=True)
    per_round = {r["round"]: r.n for r in rounds.groupBy("round").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(per_round.values()) == {events.count()}
