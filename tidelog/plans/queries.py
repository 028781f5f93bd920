"""Registered queries: every operator of the inventory run over the shared
test data. Each function takes ``(spark, sf_dir)`` and returns a DataFrame
whose columns match the DuckDB oracle in ``tidelog.plans.oracle``.

Time values are returned as epoch microseconds (BIGINT) and doubles are
rounded, so the comparison does not depend on time-zone or float printing.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.functions import columns as C
from tidelog.operators import batches as B
from tidelog.operators import catalog as CAT
from tidelog.operators import consume as CON
from tidelog.operators import envelope as ENV
from tidelog.operators import publish as PUB
from tidelog.operators import stats as ST
from tidelog.operators.offsets import assign_offsets
from tidelog.sources import testdata as td
from tidelog.sources.stored_log import StoredLog
from tidelog.sources.tables import broadcast_if_bounded, checkpoint_dir, cut_lineage, read_table

# Fixed parameters of the registered queries
READER = ("service", "svc_reporting")
SESSION_SCOPES = ["view.read", "orders.read"]
DELETED_TYPES = ["error"]
MAX_UNCOMMITTED = 100
KEEPALIVE_LIMIT = 2
STREAM_LIMIT = 1000
LIST_APPLICATION = "BUILDING"
LIST_TYPES = ["click", "view"]
PAGE_LIMIT = 10
PAGE_OFFSET = 5
WRITE_FAIL_PARTITION = "3"
FLUSH_TIMEOUT_S = 1
PUBLISH_BLOCK = 50
MAX_IN_FLIGHT = 3000
BOUNDED_BATCHES = 1_000_000_000
# Schemas by type that contradict each other: a value is a number here and a string there.
TYPE_SCHEMAS = {
    "click": '{"type":"object","required":["value"],"properties":{"value":{"type":"number"},"user_id":{"type":"integer"}}}',
    "view": '{"type":"object","required":["value"],"properties":{"value":{"type":"string"}}}',
    "purchase": '{"type":"object","required":["receipt"],"properties":{"receipt":{"type":"string"}}}',
    "signup": '{"type":"object"}',
}


def micros(c) -> F.Column:
    return F.unix_micros(c.cast("timestamp") if isinstance(c, F.Column) else F.col(c).cast("timestamp"))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    return os.path.join(checkpoint_dir(spark), "scratch", f"{name}-{uuid.uuid4().hex}")


def _log(spark, sf):
    return td.event_log(spark, sf)


def _cursors(spark, sf):
    """The fixture cursors; they only count events per partition, so they are
    derived from the base events, not from the offset computation."""
    return td.cursors(td.base_events(spark, sf))


def _env(spark, sf):
    return td.with_envelope(_log(spark, sf))


def _parsed(spark, sf):
    return B.parse_batches(td.batch_lines(_env(spark, sf)).select("batch_no", "line"))


# ---------------------------------------------------------------------------
# flagship: events -> envelopes -> batches -> decode -> dead letter -> lag
# ---------------------------------------------------------------------------

def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Consumer report per (event_type, partition): events received in good
    batches, batches diverted to the dead-letter table, and what of the
    received events is beyond the committed cursor and how old it is."""
    log = _log(spark, sf)
    parsed = B.parse_batches(td.batch_lines(td.with_envelope(log)).select("line"))
    return CON.consumer_report(parsed, _cursors(spark, sf))


# ---------------------------------------------------------------------------
# log layout
# ---------------------------------------------------------------------------

def q_assign_offsets(spark, sf):
    """W1."""
    return assign_offsets(td.base_events(spark, sf)).select("event_id", "event_type", "partition", "offset")


def q_chunk_batches(spark, sf):
    """W2."""
    lines = td.batch_lines(_env(spark, sf)).filter(~F.col("keepalive"))
    return lines.select("event_type", "partition", "batch_no", F.col("last_offset").alias("last_offset"),
                        F.col("n_events").cast("bigint").alias("n_events"))


def q_read_batches(spark, sf):
    """S1 + S10 + P10: write gzip-compressed batch files, read them back."""
    path = scratch_dir(spark, "batches")
    td.batch_lines(_env(spark, sf)).select("line").write.option("compression", "gzip").text(path)
    parsed = B.parse_batches(B.read_batches(spark, path))
    return parsed.groupBy(F.col("cursor.event_type").alias("event_type"), F.col("cursor.partition").alias("partition")) \
        .agg(F.count(F.lit(1)).alias("batches"),
             F.count(F.when(F.col("keepalive"), 1)).alias("keepalives"),
             F.sum(F.when(~F.col("keepalive"), F.col("n_events")).otherwise(0)).cast("bigint").alias("events"))


def q_split_good_bad(spark, sf):
    """P13 + P14: the dead-letter table (whole batches, cursor kept)."""
    _, bad = B.split_good_bad(_parsed(spark, sf))
    return bad.select(F.col("cursor.event_type").alias("event_type"), F.col("cursor.partition").alias("partition"),
                      C.offset_num("cursor.offset").alias("batch_offset"),
                      F.col("n_events").cast("bigint").alias("n_events"), "error")


def q_decode_events(spark, sf):
    """Events of good batches, decoded."""
    good, _ = B.split_good_bad(_parsed(spark, sf))
    ev = B.explode_events(good)
    md = ENV.get_metadata(F.col("category"), F.col("metadata"))
    return ev.select("event_type", "partition", "offset", "category", "data_op", "data_type",
                     md.getField("eid").alias("eid"), md.getField("event_type").alias("md_event_type"),
                     micros(md.getField("occurred_at")).alias("occurred_us"),
                     md.getField("partition_compaction_key").alias("compaction_key"),
                     F.col("payload.user_id").alias("user_id"), F.round("payload.value", 4).alias("value"),
                     F.col("payload.k").alias("k"))


def q_classify_events(spark, sf):
    """P1-P4 per event text: category and whether it decodes."""
    env = ENV.decode_events(_env(spark, sf).select("event_id", "raw"), "raw", S.EVENT_PAYLOAD)
    return env.select("event_id", "category", F.col("error").isNotNull().alias("failed"))


def q_event_id(spark, sf):
    """Metadata eid, else the first eid key of an undefined event."""
    env = _env(spark, sf)
    return env.select("event_id", ENV.event_id(F.col("category"), F.col("metadata"), F.col("raw")).alias("resolved_eid"))


def q_is_uuid(spark, sf):
    """UUID check over ids, every 13th id corrupted."""
    e = read_table(spark, sf, "events").select("event_id")
    ident = C.md5_uuid(F.col("event_id"))
    bad = F.concat(F.lit("x"), F.substring(ident, 2, 100))
    s = F.when(F.col("event_id") % 13 == 0, bad).otherwise(ident)
    return e.select("event_id", C.is_uuid(s).alias("is_uuid"),
                    C.is_enum(F.element_at(F.array(*[F.lit(x) for x in S.DATA_OPERATIONS + ["X"]]),
                                           (F.col("event_id") % 5 + 1).cast("int")), S.DATA_OPERATIONS).alias("is_op"))


# ---------------------------------------------------------------------------
# consumption
# ---------------------------------------------------------------------------

def q_unconsumed(spark, sf):
    """J4."""
    log = _log(spark, sf)
    return CON.unconsumed(log, _cursors(spark, sf)).select("event_id", "event_type", "partition", "offset")


def q_subscription_stats(spark, sf):
    """A1 + A2."""
    log = _log(spark, sf)
    return CON.subscription_stats(log, _cursors(spark, sf), show_time_lag=True)


def q_cursors_get(spark, sf):
    """S9 + F9: committed cursors of the fixture subscription, numeric."""
    cur = CON.cursors_of(_cursors(spark, sf), td.SUBSCRIPTION_ID)
    return cur.select("event_type", "partition", "offset", C.offset_num("offset").alias("offset_num"))


def _initial_cursors(log: DataFrame) -> DataFrame:
    """Start cursors: offset 100 in partitions 0-3, BEGIN in 4-5, none in 6-7."""
    keys = log.select("event_type", "partition").distinct()
    return keys.filter(F.col("partition").isin("0", "1", "2", "3", "4", "5")).select(
        "event_type", "partition",
        F.when(F.col("partition").isin("4", "5"), F.lit(S.BEGIN_OFFSET)).otherwise(F.lit("100")).alias("offset"))


def q_read_from_cursors(spark, sf):
    """P22."""
    log = _log(spark, sf)
    r = CON.read_from_cursors(log, _initial_cursors(log))
    return r.groupBy("event_type", "partition").agg(F.count(F.lit(1)).alias("events"),
                                                    F.min("offset").alias("first_offset"))


def q_stream_limit(spark, sf):
    """The first 1000 unconsumed events over all partitions."""
    log = _log(spark, sf)
    return CON.stream_limit(CON.unconsumed(log, _cursors(spark, sf)), STREAM_LIMIT) \
        .select("event_id", "event_type", "partition", "offset")


def q_read_bounded(spark, sf):
    """The batches of the whole subscription, within a bound (beyond it: an error)."""
    lines = td.batch_lines(_env(spark, sf)).select("batch_no", "line")
    return B.read_bounded(B.parse_batches(lines), BOUNDED_BATCHES, lines).select(
        F.col("cursor.event_type").alias("event_type"), F.col("cursor.partition").alias("partition"),
        "batch_no", "keepalive", F.col("n_events").cast("bigint").alias("n_events"))


def _commits(log: DataFrame) -> DataFrame:
    sent = td.sent_batches(log).filter(~F.col("keepalive"))
    return sent.filter("committed").select(
        F.lit(td.SUBSCRIPTION_ID).alias("subscription_id"), "event_type", "partition", "offset",
        C.md5_uuid(F.concat_ws("/", "event_type", "partition", F.col("batch_no").cast("string"))).alias("cursor_token"),
        "commit_ts")


def q_commit_cumulative(spark, sf):
    """A3."""
    a = CON.commit_cumulative(_commits(_log(spark, sf)))
    return a.select("event_type", "partition", "offset", "cursor_token")


def q_commit_cursors(spark, sf):
    """Commit every committed batch cursor against the stored cursors."""
    log = _log(spark, sf)
    table, results = CON.commit_cursors(_cursors(spark, sf), _commits(log).drop("commit_ts"))
    return results.select("event_type", "partition", C.offset_num("offset").alias("offset_num"), "result")


def q_reset_cursors(spark, sf):
    """Reset the fixture subscription to its first batches; a reset for an
    unknown subscription is refused."""
    log = _log(spark, sf)
    subs = td.subscriptions(spark, sf)
    stored = _cursors(spark, sf)
    first = td.sent_batches(log).filter((F.col("batch_no") == 0) & ~F.col("keepalive"))
    resets = first.select(F.lit(td.SUBSCRIPTION_ID).alias("subscription_id"), "event_type", "partition", "offset",
                          F.lit("reset").alias("cursor_token")).unionByName(
        first.select(F.lit(td.UNKNOWN_SUBSCRIPTION_ID).alias("subscription_id"), "event_type", "partition", "offset",
                     F.lit("reset").alias("cursor_token")))
    table, _ = CON.reset_cursors(stored, subs, resets)
    return table.select("subscription_id", "event_type", "partition", "offset", "reset")


def _timeline(spark, sf):
    """The batch timeline, written to the shared checkpoint folder: it is read
    twice by the bucketed prefix sums, and its own lineage (the log offsets)
    should not be planned -- or recomputed -- twice."""
    return cut_lineage(td.sent_batches(_log(spark, sf)))


def q_expired_batches(spark, sf):
    """Batches not committed within 60 s."""
    sent = _timeline(spark, sf).filter(~F.col("keepalive"))
    commits = sent.filter("committed").select("event_type", "partition", "offset", "commit_ts")
    lost = CON.expired_batches(sent.select("event_type", "partition", "offset", "batch_no", "sent_ts"), commits)
    return lost.select("event_type", "partition", "batch_no")


def q_inflight_pause(spark, sf):
    """W6."""
    sent = _timeline(spark, sf).filter(~F.col("keepalive"))
    p = CON.inflight_pause(sent, MAX_UNCOMMITTED)
    return p.select("event_type", "partition", "batch_no", F.col("outstanding_before").cast("bigint"), "paused")


def q_keepalive_runs(spark, sf):
    """W7."""
    sent = _timeline(spark, sf)
    r = CON.keepalive_runs(sent, KEEPALIVE_LIMIT, order=("sent_ts", "event_type", "partition", "offset", "keepalive"))
    return r.select("event_type", "partition", "batch_no", "keepalive",
                    F.col("island").cast("bigint"), "run_length", "closes")


# ---------------------------------------------------------------------------
# aggregates and catalog
# ---------------------------------------------------------------------------

def _compacted_types(spark, env: DataFrame) -> DataFrame:
    """Events of the types whose registry row asks for compaction."""
    reg = td.registry(spark).filter(F.col("cleanup_policy") == "compact").select(F.col("name").alias("event_type"))
    return env.join(broadcast_if_bounded(reg), "event_type", "left_semi").select(
        "event_type", "partition", F.col("metadata.partition_compaction_key").alias("partition_compaction_key"),
        "event_id", "offset")


def q_compact_latest(spark, sf):
    """A7 over the compacted types."""
    log = _compacted_types(spark, _env(spark, sf))
    return CAT.compact_latest(log).select(
        "event_type", "partition", "partition_compaction_key", "event_id", "offset")


def q_traffic_statistics(spark, sf):
    """Counts per active minute and bytes per message, of the events' JSON properties."""
    messages = read_table(spark, sf, "events").select("event_type", "ts", F.col("props").alias("raw"))
    t = ST.traffic_statistics(messages)
    return t.select("event_type", "messages_per_minute", "message_size", F.col("active_minutes").cast("bigint"))


def q_trace_counts(spark, sf):
    """A9 + F8 over the decoded events."""
    env = ENV.decode_events(_env(spark, sf).select("raw"), "raw", S.EVENT_PAYLOAD).filter(F.col("error").isNull())
    return ST.trace_counts(env)


def q_partition_counts(spark, sf):
    """A10."""
    return ST.partition_counts(_log(spark, sf))


def q_order_in_instance(spark, sf):
    """W3 on lineitem: instances are orders, the key is the line number,
    arrival is by ship date."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    r = CAT.order_in_instance(li, ["l_orderkey"], ["l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "key_rank", "arrival_rank",
                    "out_of_order")


def _requests(spark, sf) -> DataFrame:
    """One subscription lookup per nation (fixture rule, see oracle)."""
    n = read_table(spark, sf, "nation").select("n_nationkey")
    segs = F.array(*[F.lit(x) for x in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]])
    types = F.array(*[F.lit(x) for x in td.EVENT_TYPES])
    t1 = F.element_at(types, (F.col("n_nationkey") % 5 + 1).cast("int"))
    t2 = F.element_at(types, ((F.col("n_nationkey") + 2) % 5 + 1).cast("int"))
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("request_id"),
        F.element_at(segs, ((F.col("n_nationkey") * 3) % 5 + 1).cast("int")).alias("owning_application"),
        F.when(F.col("n_nationkey") % 3 == 0, F.array(t1)).otherwise(F.array(t1, t2)).alias("event_types"),
        F.when(F.col("n_nationkey") % 2 == 1, F.concat(F.lit("cg-"), (F.col("n_nationkey") % 3).cast("string")))
        .alias("consumer_group"),
        F.lit(None).cast("string").alias("id"),
    )


def q_find_subscription(spark, sf):
    """J2 + L3."""
    return CAT.find_subscription(td.subscriptions(spark, sf), _requests(spark, sf))


def q_create_if_absent(spark, sf):
    """Results per request; requests with a 4th type rarely match."""
    req = _requests(spark, sf).withColumn(
        "event_types", F.when(F.col("request_id") % 4 == 0,
                              F.array_union("event_types", F.array(F.lit("error"), F.lit("signup"), F.lit("view"))))
        .otherwise(F.col("event_types")))
    _, res = CAT.create_if_absent(td.subscriptions(spark, sf), req,
                                  F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    return res.select("request_id", "subscription_id", "created")


def q_list_subscriptions(spark, sf):
    """L1: one page, newest first."""
    s = CAT.list_subscriptions(td.subscriptions(spark, sf), LIST_APPLICATION, LIST_TYPES, PAGE_LIMIT, PAGE_OFFSET)
    return s.select("id", "owning_application", "consumer_group", micros("created_at").alias("created_us"))


def q_page_links(spark, sf):
    """L2."""
    return CAT.page_links(td.subscriptions(spark, sf), PAGE_LIMIT, PAGE_OFFSET, LIST_APPLICATION, LIST_TYPES)


def q_subscription_get(spark, sf):
    """The fixture subscription."""
    s = CAT.subscription(td.subscriptions(spark, sf), td.SUBSCRIPTION_ID)
    return s.select("id", "owning_application", F.array_join("event_types", ",").alias("event_types"),
                    "consumer_group", "read_from")


def q_authorized_events(spark, sf):
    """Events a reporting service may read."""
    ev = read_table(spark, sf, "events").select("event_id", "event_type")
    return CAT.authorized_events(ev, td.registry(spark), *READER)


def q_drop_deleted_types(spark, sf):
    """J7."""
    ev = read_table(spark, sf, "events").select("event_id", "event_type")
    deleted = spark.createDataFrame([(t,) for t in DELETED_TYPES], "event_type string")
    return CAT.drop_deleted_types(ev, deleted)


def q_with_event_type(spark, sf):
    """J8 + S7: every event with its type's strategies."""
    ev = read_table(spark, sf, "events").select("event_id", "event_type")
    return CAT.with_event_type(ev, td.registry(spark), ["partition_strategy", "cleanup_policy", "category"]) \
        .withColumnRenamed("category", "type_category")


def q_retention_filter(spark, sf):
    """P20: as of the newest event."""
    log = read_table(spark, sf, "events").select("event_id", "event_type", "ts")
    # as_of is a scalar subquery: one partial max per task, no whole-table window
    as_of = log.select(F.max("ts")).scalar().cast("timestamp")
    kept = CAT.retention_filter(log, td.registry(spark), as_of)
    return kept.select("event_id", "event_type")


def q_scope_allowed(spark, sf):
    """Events per type readable with the session's scopes."""
    reg = td.registry(spark).filter(CAT.scope_allowed(F.col("read_scopes"), SESSION_SCOPES))
    ev = read_table(spark, sf, "events").select("event_type")
    allowed = ev.join(broadcast_if_bounded(reg.select(F.col("name").alias("event_type"))), "event_type", "left_semi")
    return allowed.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


# ---------------------------------------------------------------------------
# publishing
# ---------------------------------------------------------------------------

def _publish_input(spark, sf) -> DataFrame:
    env = td.publish_batches(_env(spark, sf))
    return env.select("event_id", "batch_id", "event_type", "category", "metadata", "payload",
                      "data_type", "data_op", "raw")


def _write_failed(round_no: int = 0) -> F.Column:
    """Simulated broker write failures: partition 3 of every 4th block fails in
    rounds 0-2."""
    blk = F.split(F.col("batch_id"), "/").getItem(1).cast("bigint")
    return (F.col("partition") == WRITE_FAIL_PARTITION) & (blk % 4 == F.lit(round_no % 4)) & F.lit(round_no <= 2)


def q_publish_once(spark, sf):
    """Q1 (P6, P17-P19, X1, W4, W5)."""
    ev = _publish_input(spark, sf)
    out = PUB.publish_once(ev, td.registry(spark), S.EVENT_PAYLOAD, F.current_timestamp(), _write_failed(0))
    return out.select("event_id", "eid", "partition", "publishing_status", "step")


def q_assign_partition(spark, sf):
    """X1."""
    ev = _publish_input(spark, sf)
    p = PUB.assign_partition(ev, td.registry(spark))
    return p.select("event_id", "partition", F.col("partition_error").isNotNull().alias("rejected"))


def q_validate_events(spark, sf):
    """P17 + P18; some events are padded beyond the size limit."""
    ev = _publish_input(spark, sf)
    padded = F.concat("raw", F.repeat(F.lit(" "), S.MAX_EVENT_BYTES))
    ev = ev.withColumn("raw", F.when(F.col("event_id") % 1009 == 5, padded).otherwise(F.col("raw")))
    v = PUB.with_validation(ev, S.EVENT_PAYLOAD, out="violation")
    return v.select("event_id", PUB.size_ok(F.col("raw")).alias("size_ok"), "violation")


def q_validate_by_type(spark, sf):
    """P18 by the registry: every event against the schema of its type."""
    reg = td.registry(spark).withColumn("schema", F.try_element_at(
        F.create_map(*[F.lit(x) for kv in TYPE_SCHEMAS.items() for x in kv]), F.col("name")))
    return PUB.with_type_validation(_publish_input(spark, sf), reg, out="violation").select("event_id", "violation")


def q_partition_by_path(spark, sf):
    """X1 with nested key paths; an absent, null or nested-away key is refused."""
    e = read_table(spark, sf, "events").select("event_id", "user_id")
    user = F.when(F.col("event_id") % 7 == 0, F.lit("null")).when(F.col("event_id") % 7 == 1, F.lit('"x"')) \
        .otherwise(F.concat(F.lit('{"id":'), F.col("user_id").cast("string"), F.lit(',"e.id":1}')))
    body = F.concat(F.lit('{"user":'), user, F.lit(',"note":"{\\"user\\":{\\"id\\":0}}"}'))
    data = F.col("event_id") % 2 == 0
    ev = e.select("event_id", F.lit("orders").alias("event_type"), F.when(data, "data").otherwise("undefined").alias("category"),
                  F.when(data, F.concat(F.lit('{"data":'), body, F.lit("}"))).otherwise(body).alias("raw"),
                  F.lit(None).cast(S.plain(S.METADATA)).alias("metadata"))
    reg = spark.createDataFrame([("orders", "hash", ["user.id"], td.N_PARTITIONS)],
                                "name string, partition_strategy string, partition_key_fields array<string>, n_partitions int")
    return PUB.assign_partition(ev, reg).select("event_id", "partition", "partition_error")


def q_event_id_deep(spark, sf):
    """P9 on free JSON: escaped keys, keys that end in or quote the name, nesting, values that are no UUID."""
    e = read_table(spark, sf, "events").select("event_id")
    ident = C.md5_uuid(F.col("event_id"))
    shapes = ['{"a\\"eid":"no","b":[{"c":{"eid":"@"}}],"eid":"late"}', '{"x":"\\"eid\\":\\"no\\"","\\u0065\\u0069d" : "@"}',
              '{"eid":{"eid":"@"}}', '{"eid":7,"z":{"eid":"@"}}', '{"my eid":"@","t":"eid"}', '{"p":"\\\\","eid":"@"}', '{"k":["eid","@"]}']
    shape = F.element_at(F.array(*[F.lit(x) for x in shapes]), (F.col("event_id") % len(shapes) + 1).cast("int"))
    none = F.lit(None).cast(S.plain(S.METADATA))
    return e.select("event_id", ENV.event_id(F.lit("undefined"), none, F.replace(shape, F.lit("@"), ident)).alias("resolved_eid"))


def q_encode_events(spark, sf):
    """the text of events whose free payload has a ``metadata`` object and null keys of its own."""
    e = td.base_events(spark, sf)
    payload = F.concat(F.lit('{"z":{"n":null,"s":"a\\":null,b"},"user_id":'), F.col("user_id").cast("string"),
                       F.lit(',"gone":null,"metadata":{"eid":"own","flow_id":"own","team":"t'), (F.col("event_id") % 3).cast("string"),
                       F.lit('","span_ctx":{"own":"1","both":"1"}}}'))
    md = F.struct("eid", F.lit("2024-05-06 07:08:09").cast("timestamp").alias("occurred_at"), "event_type",
                  *[F.lit(None).cast(t).alias(n) for n, t in (("received_at", "timestamp"), ("parent_eids", "array<string>"), ("flow_id", "string"))],
                  "partition", F.lit(None).cast("string").alias("partition_compaction_key"),
                  F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("both"), F.lit("2"))).alias("span_ctx"),
                  F.lit(None).cast("string").alias("published_by"))
    return e.select("event_id", ENV.encode_event_text(F.col("category"), md, payload, F.col("event_type"), F.col("data_op")).alias("raw"))


def q_enrich_metadata(spark, sf):
    """P19."""
    ev = _publish_input(spark, sf)
    e = PUB.enrich_metadata(ev, td.registry(spark), F.lit("2025-01-01 00:00:00").cast("timestamp"), flow_id=F.lit("flow-1"))
    return e.select("event_id", "enrich_error", F.col("metadata.flow_id").alias("flow_id"),
                    micros(F.col("metadata.received_at")).alias("received_us"))


def _round0(spark, sf) -> DataFrame:
    ev = _publish_input(spark, sf)
    return PUB.publish_once(ev, td.registry(spark), S.EVENT_PAYLOAD, F.current_timestamp(), _write_failed(0))


def q_events_to_retry(spark, sf):
    """J1 after one round."""
    out = _round0(spark, sf)
    responses = out.select("eid", "publishing_status", "step")
    return PUB.events_to_retry(_publish_input(spark, sf), responses).select("event_id")


def q_outcome_summary(spark, sf):
    """A4."""
    s = PUB.outcome_summary(_round0(spark, sf))
    return s.select("publishing_status", "step", F.col("items").cast("bigint"), "call_ok")


def q_failed_ids(spark, sf):
    """A5 per publish call."""
    return PUB.failed_ids(_round0(spark, sf), ["batch_id"])


def q_merge_rejects(spark, sf):
    """A6 + U1 + U2 + U3: rejects of the fixture outcomes and of round 0."""
    o = td.outcomes(spark, sf)
    r0 = _round0(spark, sf).select("eid", "publishing_status", "step")
    rej_a, _ = PUB.partition_split(o.select("eid", "publishing_status", "step"),
                                   PUB.not_submitted(F.col("publishing_status")))
    rej_b, _ = PUB.partition_split(r0, PUB.not_submitted(F.col("publishing_status")))
    both = PUB.union_rejects(rej_a, rej_b)
    merged = PUB.merge_rejects(rej_a, rej_b)
    return merged.groupBy("publishing_status", "step").agg(F.count(F.lit(1)).alias("distinct_rejects")) \
        .join(both.groupBy("publishing_status", "step").agg(F.count(F.lit(1)).alias("all_rejects")),
              ["publishing_status", "step"], "full")


def q_needs_retry(spark, sf):
    """P15 + P16 over the fixture outcomes."""
    o = td.outcomes(spark, sf)
    return o.select("event_id", PUB.needs_retry(F.col("publishing_status"), F.col("step")).alias("needs_retry"),
                    PUB.not_submitted(F.col("publishing_status")).alias("not_submitted"))


def q_read_outcomes(spark, sf):
    """Decode partial-failure responses (JSON arrays of items) per call."""
    o = td.outcomes(spark, sf).withColumn("call", (F.col("event_id") / 50).cast("bigint")) \
        .withColumn("publishing_status", F.when(F.col("event_id") % 61 == 0, "lost").otherwise(F.col("publishing_status")))
    bodies = o.groupBy("call").agg(F.to_json(F.array_sort(F.collect_list(
        F.struct("event_id", "eid", "publishing_status", "step", "detail")))).alias("body"))
    items = PUB.read_outcomes(bodies)
    return items.select("call", F.col("item_no").cast("bigint").alias("item_no"), "eid", "publishing_status", "step", "detail",
                        "item_error")


def q_error_kind(spark, sf):
    """F3 over error bodies built from the outcomes."""
    o = td.outcomes(spark, sf)
    m = F.col("event_id") % 4
    body = (F.when(m == 0, F.concat(F.lit('{"title":"Unprocessable","status":422,"detail":"'),
                                    F.coalesce("detail", F.lit("none")), F.lit('"}')))
            .when(m == 1, F.lit('{"error":"x","error_description":"y"}'))
            .when(m == 2, F.concat(F.lit("oops "), F.col("event_id").cast("string")))
            .otherwise(F.lit("")))
    found = ENV.with_error_fields(o.select("event_id", body.alias("body")), "body")
    return found.select("event_id", "kind", "title", F.col("status").cast("bigint").alias("status"), "detail", "error",
                        "error_description", "text")


def q_mask_token(spark, sf):
    """F4 over request log lines."""
    e = read_table(spark, sf, "events").select("event_id", "user_id")
    line = F.concat(F.lit("GET /events?user="), F.col("user_id").cast("string"),
                    F.lit(" Authorization: Bearer "), F.md5(F.col("event_id").cast("string")))
    return e.select("event_id", C.mask_token(line).alias("line"))


def q_backoff_delay(spark, sf):
    """the retry schedule of every item that may be retried."""
    o = td.outcomes(spark, sf).filter(PUB.needs_retry(F.col("publishing_status"), F.col("step")))
    k = F.explode(F.sequence(F.lit(0), F.lit(S.BACKOFF_MAX_RETRIES)))
    return o.select("event_id", k.alias("k")).select(
        "event_id", F.col("k").cast("bigint").alias("k"), F.round(C.backoff_delay_ms(F.col("k")), 3).alias("delay_ms"))


def q_parse_offset_ts(spark, sf):
    """timestamps with and without offset."""
    e = read_table(spark, sf, "events").select("event_id", "ts")
    base = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    text = (F.when(F.col("event_id") % 3 == 0, F.concat(base, F.lit("Z")))
            .when(F.col("event_id") % 3 == 1, F.concat(base, F.lit("+02:00")))
            .otherwise(base))
    return e.select("event_id", micros(C.parse_offset_ts(text)).alias("parsed_us"))


def q_publish_with_retry(spark, sf):
    """Q2: retry rounds until nothing is retryable or retries run out."""
    from tidelog.plans.retry import publish_with_retry

    rounds = publish_with_retry(_publish_input(spark, sf), td.registry(spark), S.EVENT_PAYLOAD, _write_failed)
    return rounds


# ---------------------------------------------------------------------------
# streaming (run to completion with availableNow, into fresh scratch folders)
# ---------------------------------------------------------------------------

def q_stream_consume(spark, sf):
    """T1 + T3 + T13 + S2: batch files streamed through the consumer; good
    events to a sink, bad batches to the dead-letter table, cursors committed."""
    from tidelog.streaming import consume as SC

    root = scratch_dir(spark, "consume")
    td.batch_lines(_env(spark, sf)).select("line").repartition(4).write.text(f"{root}/in")
    sink = f"{root}/events"

    def handle(events, batch_id):
        events.select("event_type", "partition", "offset").write.mode("append").parquet(sink)

    q = SC.consume(SC.batch_source(spark, f"{root}/in", SC.StreamOptions(batch_limit=20)), td.SUBSCRIPTION_ID,
                   handle, f"{root}/cursors", f"{root}/dead", f"{root}/ckpt", commit_policy="success_always")
    q.awaitTermination()
    got = spark.read.parquet(sink).groupBy("event_type", "partition").agg(
        F.count(F.lit(1)).alias("received_events"))
    dead = spark.read.parquet(f"{root}/dead").groupBy(
        F.col("cursor.event_type").alias("event_type"), F.col("cursor.partition").alias("partition")) \
        .agg(F.count(F.lit(1)).alias("dead_letter_batches"))
    cur = SC.committed_cursors(spark, f"{root}/cursors").select(
        "event_type", "partition", C.offset_num("offset").alias("committed_offset"))
    return cur.join(got, ["event_type", "partition"], "left").join(dead, ["event_type", "partition"], "left") \
        .select("event_type", "partition", "committed_offset",
                F.coalesce("received_events", F.lit(0)).cast("bigint").alias("received_events"),
                F.coalesce("dead_letter_batches", F.lit(0)).cast("bigint").alias("dead_letter_batches"))


def q_publish_append(spark, sf):
    """S5 + Q1: two publish calls into a stored log, each repeated; the log's rows."""
    log = StoredLog(spark, scratch_dir(spark, "log"))
    env = td.publish_batches(td.with_envelope(td.base_events(spark, sf)))
    events = env.select("event_id", "ts", "batch_id", "event_type", "category", "metadata", "payload", "data_type", "data_op", "raw")
    half = (F.col("event_id") / PUBLISH_BLOCK).cast("bigint") % 2
    for _ in range(2):
        for n in (0, 1):
            PUB.publish_append(events.filter(half == n), td.registry(spark), log, f"call-{n}", S.EVENT_PAYLOAD, F.current_timestamp())
    return log.read("event_type string, partition string, event_id bigint, offset bigint")


def q_stream_subscription(spark, sf):
    """S2 + S3 + P22 + T7: consume a stored log up to its end, again after an append with the same
    checkpoint, and again after a reset with a new one; events received in each run, and the cursors."""
    from tidelog.streaming import consume as SC
    from tidelog.streaming import log_source as LS

    root = scratch_dir(spark, "subscription")
    log = StoredLog(spark, f"{root}/log")
    td.with_envelope(td.base_events(spark, sf)).filter(F.col("event_id") % 97 != 0) \
        .select("event_id", "ts", "event_type", "partition", "raw").write.parquet(f"{root}/events")
    events = spark.read.parquet(f"{root}/events")
    options = SC.StreamOptions(max_uncommitted_events=MAX_IN_FLIGHT, batch_limit=50, batch_flush_timeout=1, stream_keep_alive_limit=3)

    def run(number: int, checkpoint: str) -> None:
        def handle(got, batch_id):
            got.select(F.lit(number).alias("run"), "event_type", "partition").write.mode("overwrite") \
                .parquet(f"{root}/out/at={number}-{batch_id}")

        LS.run_subscription(spark, log.path, f"{root}/cursors", f"{root}/dead", td.SUBSCRIPTION_ID, handle,
                            f"{root}/{checkpoint}", options)

    log.append(events.filter(F.col("event_id") % 2 == 0), "first")
    run(1, "a")
    log.append(events.filter(F.col("event_id") % 2 == 1), "second")
    run(2, "a")
    live = SC.committed_cursors(spark, f"{root}/cursors")
    back = F.when(F.col("partition") == "0", "9").when(F.col("partition") == "1", S.BEGIN_OFFSET)
    SC.reset_stored(live.withColumn("offset", back).filter("offset IS NOT NULL"), f"{root}/cursors")
    run(3, "b")
    got = spark.read.parquet(f"{root}/out").groupBy("event_type", "partition").agg(
        *[F.count(F.when(F.col("run") == n, 1)).alias(f"run_{n}") for n in (1, 2, 3)])
    cursors = SC.committed_cursors(spark, f"{root}/cursors").select("event_type", "partition", C.offset_num("offset").alias("committed"))
    return got.join(cursors, ["event_type", "partition"], "full")


def q_stream_expired(spark, sf):
    """J5 on a stream: sent batches and commits as two streams, a last row in each that moves the watermarks on."""
    from tidelog.streaming import stateful as ST2

    root = scratch_dir(spark, "expired")
    sent = _timeline(spark, sf).filter(~F.col("keepalive"))
    end = sent.agg(F.max("sent_ts").alias("at")).select(F.lit("end").alias("event_type"), F.lit("0").alias("partition"),
                                                        F.lit(0).cast("bigint").alias("batch_no"), F.lit("0").alias("offset"),
                                                        (F.col("at") + F.expr("INTERVAL 1 HOUR")).alias("at"))
    rows = sent.select("event_type", "partition", "batch_no", "offset", F.col("sent_ts").alias("at"))
    rows.unionByName(end).withColumnRenamed("at", "sent_ts").write.parquet(f"{root}/sent")
    commits = sent.filter("committed").select("event_type", "partition", "batch_no", "offset", F.col("commit_ts").alias("at"))
    commits.unionByName(end).withColumnRenamed("at", "commit_ts").write.parquet(f"{root}/commits")
    schema = "event_type string, partition string, batch_no long, offset string, {} timestamp"
    lost = ST2.expired_stream(spark.readStream.schema(schema.format("sent_ts")).parquet(f"{root}/sent"),
                              spark.readStream.schema(schema.format("commit_ts")).parquet(f"{root}/commits").drop("batch_no"))
    q = lost.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.schema(schema.format("sent_ts")).parquet(f"{root}/out")
    return out.filter(F.col("event_type") != "end").select("event_type", "partition", "batch_no")


def q_stream_flush(spark, sf):
    """Batches flushed at the batch limit, and the rest of each partition on timeout (stateful)."""
    from tidelog.streaming import stateful as ST2

    root = scratch_dir(spark, "flush")
    _log(spark, sf).select("event_type", "partition", "offset").write.parquet(f"{root}/in")
    src = spark.readStream.schema("event_type string, partition string, offset long").parquet(f"{root}/in")
    # a processing-time timeout always asks for another (no-data) batch, so
    # neither availableNow nor processAllAvailable ends: drain, then stop
    q = ST2.flush_batches(src, td.BATCH_LIMIT, FLUSH_TIMEOUT_S).writeStream.outputMode("append") \
        .format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt") \
        .trigger(processingTime="1 second").start()
    from tidelog.streaming.consume import drain

    drain(q, settle_s=FLUSH_TIMEOUT_S + 1)
    q.stop()
    return spark.read.parquet(f"{root}/out").select("event_type", "partition", "batch_no", "first_offset",
                                                     "last_offset", "n_events", "reason")


def q_stream_compaction(spark, sf):
    """Streaming A7 for the compacted types, merged into a kept table; events without a key pass through."""
    from tidelog.streaming import stateful as ST2
    from tidelog.streaming.latest import LatestTable

    root = scratch_dir(spark, "compact")
    keys = ["event_type", "partition", "partition_compaction_key"]
    _compacted_types(spark, _env(spark, sf)).repartition(3).write.parquet(f"{root}/in")
    src = spark.readStream.schema("event_type string, partition string, partition_compaction_key string, "
                                  "event_id long, offset long").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    keyed = F.col("partition_compaction_key").isNotNull()
    latest = ST2.streaming_latest(src.filter(keyed), keys, "offset", ["event_id"])

    schema = "event_type string, partition string, partition_compaction_key string, offset long, event_id long"
    kept = LatestTable(spark, f"{root}/latest", keys, "offset", schema)

    def upsert(df, batch_id):
        kept.merge(df, "compaction", batch_id)

    runs = [latest.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", f"{root}/ckpt"),
            src.filter(~keyed).writeStream.format("parquet").option("path", f"{root}/unkeyed")
            .option("checkpointLocation", f"{root}/ckpt-unkeyed")]
    for q in [w.trigger(availableNow=True).start() for w in runs]:
        q.awaitTermination()
    return kept.read().unionByName(spark.read.schema(schema).parquet(f"{root}/unkeyed"))


def q_stream_traffic(spark, sf):
    """Per-minute counts with a watermark, summarised like A8."""
    from tidelog.streaming import stateful as ST2

    root = scratch_dir(spark, "traffic")
    src = spark.readStream.schema(read_table(spark, sf, "events").schema) \
        .option("pathGlobFilter", "events.parquet").parquet(sf)
    counts = ST2.streaming_traffic(src)

    def upsert(df, batch_id):
        df.select("event_type", F.col("minute.start").alias("minute"), "events").write.mode("append") \
            .parquet(f"{root}/out")

    q = counts.writeStream.outputMode("update").foreachBatch(upsert) \
        .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    per_min = spark.read.parquet(f"{root}/out").groupBy("event_type", "minute").agg(F.max("events").alias("n"))
    return per_min.groupBy("event_type").agg(F.round(F.avg("n"), 6).alias("messages_per_minute"),
                                             F.count(F.lit(1)).cast("bigint").alias("active_minutes"))


QUERIES = {
    "flagship": flagship,
    "assign_offsets": q_assign_offsets,
    "chunk_batches": q_chunk_batches,
    "read_batches": q_read_batches,
    "split_good_bad": q_split_good_bad,
    "decode_events": q_decode_events,
    "classify_events": q_classify_events,
    "event_id": q_event_id,
    "is_uuid": q_is_uuid,
    "unconsumed": q_unconsumed,
    "subscription_stats": q_subscription_stats,
    "cursors_get": q_cursors_get,
    "read_from_cursors": q_read_from_cursors,
    "stream_limit": q_stream_limit,
    "read_bounded": q_read_bounded,
    "commit_cumulative": q_commit_cumulative,
    "commit_cursors": q_commit_cursors,
    "reset_cursors": q_reset_cursors,
    "expired_batches": q_expired_batches,
    "inflight_pause": q_inflight_pause,
    "keepalive_runs": q_keepalive_runs,
    "compact_latest": q_compact_latest,
    "traffic_statistics": q_traffic_statistics,
    "trace_counts": q_trace_counts,
    "partition_counts": q_partition_counts,
    "order_in_instance": q_order_in_instance,
    "find_subscription": q_find_subscription,
    "create_if_absent": q_create_if_absent,
    "list_subscriptions": q_list_subscriptions,
    "page_links": q_page_links,
    "subscription_get": q_subscription_get,
    "authorized_events": q_authorized_events,
    "drop_deleted_types": q_drop_deleted_types,
    "with_event_type": q_with_event_type,
    "retention_filter": q_retention_filter,
    "scope_allowed": q_scope_allowed,
    "publish_once": q_publish_once,
    "assign_partition": q_assign_partition,
    "validate_events": q_validate_events,
    "validate_by_type": q_validate_by_type,
    "partition_by_path": q_partition_by_path,
    "event_id_deep": q_event_id_deep,
    "encode_events": q_encode_events,
    "enrich_metadata": q_enrich_metadata,
    "events_to_retry": q_events_to_retry,
    "outcome_summary": q_outcome_summary,
    "failed_ids": q_failed_ids,
    "merge_rejects": q_merge_rejects,
    "needs_retry": q_needs_retry,
    "read_outcomes": q_read_outcomes,
    "error_kind": q_error_kind,
    "mask_token": q_mask_token,
    "backoff_delay": q_backoff_delay,
    "parse_offset_ts": q_parse_offset_ts,
    "publish_with_retry": q_publish_with_retry,
    "publish_append": q_publish_append,
    "stream_consume": q_stream_consume,
    "stream_subscription": q_stream_subscription,
    "stream_expired": q_stream_expired,
    "stream_flush": q_stream_flush,
    "stream_compaction": q_stream_compaction,
    "stream_traffic": q_stream_traffic,
}
