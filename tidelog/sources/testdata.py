"""Derive the event-log tables from the shared test data.

Every rule below is a plain column formula so that the DuckDB oracle can
repeat it (see ``__spark_entry__.oracle_sql``). All tables are derived by
Spark from ``events`` / ``customer`` / ``lineitem`` and grow with them.

Rules (fixed values of the fixture):

* partition  = md5-prefix(user_id) mod 8, as a string
* offset     = dense position per (event_type, partition) by (ts, event_id)
* eid        = md5(event_id) formatted as a UUID
* category   = event_id mod 10: 0-5 business, 6-8 data, 9 undefined
* data_op    = C, U, D, S by event_id mod 4
* metadata.event_type is "legacy.<type>" when event_id mod 89 = 1 (an
  enrichment conflict), else left out when event_id mod 3 = 0 (publish fills it)
* span_ctx   on business events with event_id mod 5 = 0
* malformed payload ("value" as text) when event_id mod 97 = 0
* undefined events carry a root "eid" unless event_id mod 20 = 19 and the
  type is click, purchase or signup
* batches    = BATCH_LIMIT events per (event_type, partition); a keep-alive
               follows every 10th batch
* cursors    = floor(0.8 * count) - 1 per (event_type, partition); partition
               6 is committed at BEGIN, partition 7 has no cursor
* outcomes   = event_id mod 10: 0 failed/validating, 1-2 aborted/enriching,
               3 aborted/partitioning, else submitted/none; eid null when
               event_id mod 50 = 7
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas as S
from tidelog.functions.columns import md5_bucket, md5_uuid
from tidelog.operators.envelope import encode_event
from tidelog.operators.offsets import assign_offsets
from tidelog.sources.tables import read_table

# Fixed values of the fixture
N_PARTITIONS = 8
BATCH_LIMIT = 20
KEEPALIVE_EVERY = 10
BEGIN_PARTITION = "6"
UNCOMMITTED_PARTITION = "7"
# the subscription of customer 1 owns the fixture cursors
SUBSCRIPTION_ID = "1873a0c8-f41a-998f-9e3e-fdd4605f9df5"  # md5("sub-1") as a UUID
UNKNOWN_SUBSCRIPTION_ID = "00000000-0000-0000-0000-000000000000"
ID_LESS_TYPES = ["click", "purchase", "signup"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the log's derived columns (no offsets yet)."""
    e = read_table(spark, sf_dir, "events")
    eid10 = F.col("event_id") % 10
    return e.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        md5_bucket(F.col("user_id"), N_PARTITIONS).cast("string").alias("partition"),
        md5_uuid(F.col("event_id")).alias("eid"),
        F.when(eid10 <= 5, "business").when(eid10 <= 8, "data").otherwise("undefined").alias("category"),
        F.element_at(F.array(*[F.lit(x) for x in S.DATA_OPERATIONS]),
                     (F.col("event_id") % 4 + 1).cast("int")).alias("_op"),
    ).withColumn("data_op", F.when(F.col("category") == "data", F.col("_op"))).drop("_op")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log: one row per event with (event_type, partition, offset). Its events lie far apart: no second is busy."""
    return assign_offsets(base_events(spark, sf_dir), rows_per_piece=None)


def with_envelope(log: DataFrame) -> DataFrame:
    """Add the publish-side event columns and the JSON text ``raw`` (F1)."""
    md = F.struct(
        F.col("eid").alias("eid"),
        F.col("ts").cast("timestamp").alias("occurred_at"),
        F.when(F.col("event_id") % 89 == 1, F.concat(F.lit("legacy."), F.col("event_type")))
        .when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type"),
        F.lit(None).cast("timestamp").alias("received_at"),
        F.lit(None).cast("array<string>").alias("parent_eids"),
        F.lit(None).cast("string").alias("flow_id"),
        F.col("partition").alias("partition"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("partition_compaction_key"),
        F.when((F.col("category") == "business") & (F.col("event_id") % 5 == 0),
               F.create_map(F.lit(S.TRACE_ID_KEY), F.substring(F.md5(F.col("user_id").cast("string")), 1, 16),
                            F.lit(S.SPAN_ID_KEY), F.substring(F.md5(F.col("event_id").cast("string")), 1, 16)))
        .alias("span_ctx"),
        F.lit(None).cast("string").alias("published_by"),
    )
    payload = F.struct("user_id", "value", "k")
    df = log.withColumn("metadata", F.when(F.col("category") != "undefined", md)) \
        .withColumn("payload", payload) \
        .withColumn("data_type", F.when(F.col("category") == "data", F.col("event_type")))
    # metadata.event_type as published (P6 fill_metadata with the table's type name)
    df = df.withColumn("metadata", F.when(
        F.col("category") != "undefined",
        F.col("metadata").withField("event_type", F.coalesce(F.col("metadata.event_type"), F.col("event_type")))))
    undefined_raw = F.to_json(F.struct(
        "user_id", "value", "k",
        F.when((F.col("event_id") % 20 != 19) | ~F.col("event_type").isin(ID_LESS_TYPES), F.col("eid")).alias("eid")))
    raw = F.when(F.col("category") == "undefined", undefined_raw).otherwise(
        encode_event(F.col("category"), F.col("metadata"), F.col("payload"), F.col("data_type"),
                     F.col("data_op"), ["user_id", "value", "k"]))
    raw = F.when(F.col("event_id") % 97 == 0, F.regexp_replace(raw, r'"value":[^,}]+', '"value":"n/a"')) \
        .otherwise(raw)
    return df.withColumn("raw", raw)


def batch_lines(log_with_raw: DataFrame, batch_limit: int = BATCH_LIMIT) -> DataFrame:
    """W2 + framing: one JSON line per batch of one (event_type, partition).

    Columns: ``event_type, partition, batch_no, last_offset, n_events, line``.
    The group per batch holds at most ``batch_limit`` events; a limit of 0 or
    None means one batch per partition (as the broker does -- unbounded, so
    only for small logs).
    """
    batch_no = F.floor(F.col("offset") / F.lit(batch_limit)).cast("bigint") if batch_limit else F.lit(0).cast("bigint")
    b = (
        log_with_raw.withColumn("batch_no", batch_no)
        .groupBy("event_type", "partition", "batch_no")
        .agg(
            F.max("offset").alias("last_offset"),
            F.count(F.lit(1)).alias("n_events"),
            F.array_sort(F.collect_list(F.struct("offset", "raw"))).alias("_evs"),
        )
    )
    cursor = F.to_json(F.struct(
        F.col("partition").alias("partition"),
        F.col("last_offset").cast("string").alias("offset"),
        F.col("event_type").alias("event_type"),
        md5_uuid(F.concat_ws("/", "event_type", "partition", F.col("batch_no").cast("string"))).alias("cursor_token"),
    ))
    info = F.when(F.col("batch_no") == 0, F.lit(',"info":{"debug":"first batch"}')).otherwise(F.lit(""))
    events = F.concat(F.lit(',"events":['), F.array_join(F.transform("_evs", lambda x: x["raw"]), ","), F.lit("]"))
    full = b.select("event_type", "partition", "batch_no", "last_offset", "n_events",
                    F.concat(F.lit('{"cursor":'), cursor, info, events, F.lit("}")).alias("line"),
                    F.lit(False).alias("keepalive"))
    keep = b.filter(F.col("batch_no") % KEEPALIVE_EVERY == KEEPALIVE_EVERY - 1).select(
        "event_type", "partition", "batch_no", "last_offset", F.lit(0).cast("bigint").alias("n_events"),
        F.concat(F.lit('{"cursor":'), cursor, F.lit("}")).alias("line"), F.lit(True).alias("keepalive"))
    return full.unionByName(keep)


def cursors(log: DataFrame, subscription_id: str = SUBSCRIPTION_ID) -> DataFrame:
    """Committed cursors of one subscription (rules in the module doc)."""
    c = log.groupBy("event_type", "partition").agg(F.count(F.lit(1)).alias("n"))
    committed = (F.expr("(n * 4) div 5") - 1).cast("bigint")  # floor(0.8 n) - 1 in integers
    return c.filter(F.col("partition") != UNCOMMITTED_PARTITION).select(
        F.lit(subscription_id).alias("subscription_id"),
        "event_type",
        "partition",
        F.when(F.col("partition") == BEGIN_PARTITION, F.lit(S.BEGIN_OFFSET))
        .otherwise(committed.cast("string")).alias("offset"),
        md5_uuid(F.concat_ws("/", F.lit("token"), "event_type", "partition")).alias("cursor_token"),
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish outcomes per event (rules in the module doc)."""
    e = read_table(spark, sf_dir, "events").select("event_id")
    m = F.col("event_id") % 10
    status = F.when(m == 0, "failed").when(m <= 3, "aborted").otherwise("submitted")
    step = F.when(m == 0, "validating").when(m <= 2, "enriching").when(m == 3, "partitioning").otherwise("none")
    detail = F.when(m == 0, F.lit("$.value: expected double")).when(m == 3, F.lit("no partition"))
    return e.select(
        "event_id",
        F.when(F.col("event_id") % 50 != 7, md5_uuid(F.col("event_id"))).alias("eid"),
        status.alias("publishing_status"),
        step.alias("step"),
        detail.alias("detail"),
    )


REGISTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("owning_application", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("enrichment_strategies", T.ArrayType(T.StringType())),
    T.StructField("partition_strategy", T.StringType()),
    T.StructField("compatibility_mode", T.StringType()),
    T.StructField("partition_key_fields", T.ArrayType(T.StringType())),
    T.StructField("cleanup_policy", T.StringType()),
    T.StructField("retention_time_ms", T.LongType()),
    T.StructField("read_scopes", T.ArrayType(T.StringType())),
    T.StructField("write_scopes", T.ArrayType(T.StringType())),
    T.StructField("admins", T.ArrayType(S.ACL_ENTRY)),
    T.StructField("readers", T.ArrayType(S.ACL_ENTRY)),
    T.StructField("writers", T.ArrayType(S.ACL_ENTRY)),
    T.StructField("ordering_key_fields", T.ArrayType(T.StringType())),
    T.StructField("ordering_instance_ids", T.ArrayType(T.StringType())),
    T.StructField("audience", T.StringType()),
    T.StructField("n_partitions", T.IntegerType()),
])

_DAY_MS = 24 * 3600 * 1000


def _acl(*pairs):
    return [{"data_type": d, "value": v} for d, v in pairs]


# Fixed registry rows of the fixture (one per event type of ``events``).
REGISTRY_ROWS = [
    ("click", "web-frontend", "business", ["metadata_enrichment"], "hash", "compatible", ["user_id"],
     "delete", 20 * _DAY_MS, ["click.read"], ["click.write"], _acl(("user", "alice")),
     _acl(("service", "svc_reporting")), _acl(("service", "svc_web")), None, None,
     "company-internal", N_PARTITIONS),
    ("error", "monitoring", "undefined", [], "random", "none", None,
     "delete", 7 * _DAY_MS, None, None, _acl(("user", "bob")),
     _acl(("*", "*")), _acl(("service", "svc_monitor")), None, None,
     "component-internal", N_PARTITIONS),
    ("purchase", "checkout", "data", ["metadata_enrichment"], "user_defined", "compatible", None,
     "compact", None, ["purchase.read", "orders.read"], ["purchase.write"], _acl(("user", "carol")),
     _acl(("service", "svc_finance"), ("user", "dave")), _acl(("service", "svc_checkout")),
     ["value"], ["user_id"], "business-unit-internal", N_PARTITIONS),
    ("signup", "accounts", "business", ["metadata_enrichment"], "hash", "forward", ["user_id"],
     "compact", None, [], ["signup.write"], _acl(("user", "erin")),
     _acl(("service", "svc_crm")), _acl(("service", "svc_accounts")), None, None,
     "external-partner", N_PARTITIONS),
    ("view", "web-frontend", "business", ["metadata_enrichment"], "random", "compatible", None,
     "delete", 25 * _DAY_MS, ["view.read"], ["view.write"], _acl(("user", "alice")),
     _acl(("service", "svc_reporting"), ("service", "svc_search")), _acl(("service", "svc_web")),
     None, None, "company-internal", N_PARTITIONS),
]


def registry(spark: SparkSession) -> DataFrame:
    """The event-type registry: a small dimension (one row per type)."""
    return spark.createDataFrame(REGISTRY_ROWS, REGISTRY_SCHEMA)


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscription per customer; ``c_mktsegment`` is the owning application.

    event_types = the types whose bit is set in c_custkey (bit i = i-th type of
    EVENT_TYPES), ``view`` when none; consumer_group null when c_nationkey
    mod 5 = 0, else ``cg-<c_nationkey mod 3>``; created_at = 2024-01-01 plus
    c_custkey minutes; read_from by c_custkey mod 3 (begin, end, cursors).
    """
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    bits = [F.when(F.shiftright(F.col("c_custkey"), i) % 2 == 1, F.lit(t)) for i, t in enumerate(EVENT_TYPES)]
    types = F.filter(F.array(*bits), lambda x: x.isNotNull())
    return c.select(
        md5_uuid(F.concat(F.lit("sub-"), F.col("c_custkey").cast("string"))).alias("id"),
        F.col("c_mktsegment").alias("owning_application"),
        F.when(F.size(types) == 0, F.array(F.lit("view"))).otherwise(types).alias("event_types"),
        F.when(F.col("c_nationkey") % 5 != 0,
               F.concat(F.lit("cg-"), (F.col("c_nationkey") % 3).cast("string"))).alias("consumer_group"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.col("c_custkey").cast("int"))).alias("created_at"),
        F.element_at(F.array(F.lit("begin"), F.lit("end"), F.lit("cursors")),
                     (F.col("c_custkey") % 3 + 1).cast("int")).alias("read_from"),
        F.col("c_custkey"),
    )


# Fixed values of the consumption timeline
COMMIT_SKIP_EVERY = 7        # batch_no mod 7 = 3 is never committed
COMMIT_DELAY_STEP_S = 20     # commit delay = (batch_no mod 5) * 20 s after sending
KEEPALIVE_DELAY_S = 30       # a keep-alive follows its batch after 30 s


def sent_batches(log: DataFrame, batch_limit: int = BATCH_LIMIT) -> DataFrame:
    """The consumption timeline of the fixture subscription, one row per batch.

    ``event_type, partition, batch_no, offset (string, the cursor), n_events,
    keepalive, sent_ts, committed, commit_ts``. A batch is sent one second
    after its newest event; keep-alives follow every 10th batch.
    """
    b = log.groupBy("event_type", "partition",
                    F.floor(F.col("offset") / F.lit(batch_limit)).cast("bigint").alias("batch_no")).agg(
        F.max("offset").alias("_last"), F.count(F.lit(1)).alias("n_events"), F.max("ts").alias("_newest"))
    sent = F.col("_newest").cast("timestamp") + F.make_dt_interval(secs=F.lit(1))
    committed = F.col("batch_no") % COMMIT_SKIP_EVERY != 3
    full = b.select(
        "event_type", "partition", "batch_no", F.col("_last").cast("string").alias("offset"), "n_events",
        F.lit(False).alias("keepalive"), sent.alias("sent_ts"), committed.alias("committed"),
        F.when(committed, sent + F.make_dt_interval(
            secs=((F.col("batch_no") % 5) * COMMIT_DELAY_STEP_S).cast("int"))).alias("commit_ts"))
    keep = full.filter(F.col("batch_no") % KEEPALIVE_EVERY == KEEPALIVE_EVERY - 1).select(
        "event_type", "partition", "batch_no", "offset", F.lit(0).cast("bigint").alias("n_events"),
        F.lit(True).alias("keepalive"),
        (F.col("sent_ts") + F.make_dt_interval(secs=F.lit(KEEPALIVE_DELAY_S))).alias("sent_ts"),
        F.lit(False).alias("committed"), F.lit(None).cast("timestamp").alias("commit_ts"))
    return full.unionByName(keep)


def publish_batches(env: DataFrame) -> DataFrame:
    """Publish requests: events of one type in blocks of 50 event ids."""
    return env.withColumn("batch_id", F.concat_ws(
        "/", F.col("event_type"), (F.col("event_id") / 50).cast("bigint").cast("string")))
