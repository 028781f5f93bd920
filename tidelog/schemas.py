"""Spark types of the event-log data model, and the closed value sets.

The envelope is fixed; the payload schema is supplied by the caller (a
``StructType``), exactly like a typed reader decides what an event body is.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the broker contract for results to agree)
# ---------------------------------------------------------------------------
DATA_OPERATIONS = ["C", "U", "D", "S"]
PUBLISHING_STATUSES = ["submitted", "failed", "aborted"]
STEPS = ["none", "validating", "partitioning", "enriching", "publishing"]
CATEGORIES = ["business", "data", "undefined"]
PARTITION_STRATEGIES = ["random", "user_defined", "hash"]
CLEANUP_POLICIES = ["compact", "delete"]
COMPATIBILITY_MODES = ["compatible", "forward", "none"]
ENRICHMENT_STRATEGIES = ["metadata_enrichment"]
AUDIENCES = [
    "business-unit-internal",
    "company-internal",
    "component-internal",
    "external-partner",
    "external-public",
]
PARTITION_STATES = ["unassigned", "reassigning", "assigned"]
ASSIGNMENT_TYPES = ["direct", "auto"]
# maximum size of one event as sent, in bytes (whitespace counts)
MAX_EVENT_BYTES = 999_000
# bounded read: more batches than this is an error, not a truncation
MAX_BOUNDED_BATCHES = 300
# commit timeout in seconds; 0 means this default
DEFAULT_COMMIT_TIMEOUT_S = 60
# batch flush timeout in seconds
DEFAULT_BATCH_FLUSH_TIMEOUT_S = 30
# reconnect waits of the managed consumer, seconds
RECONNECT_AFTER_CONFLICT_S = 60
RECONNECT_AFTER_DISCONNECT_S = 10
# publish retry backoff: initial delay (ms), factor, maximum retries
BACKOFF_INITIAL_MS = 100.0
BACKOFF_FACTOR = 1.5
BACKOFF_MAX_RETRIES = 5
# the cursor offset that precedes every event
BEGIN_OFFSET = "BEGIN"
# span context keys of the OpenTracing text-map carrier
TRACE_ID_KEY = "ot-tracer-traceid"
SPAN_ID_KEY = "ot-tracer-spanid"
# ---------------------------------------------------------------------------


def uuid_field(name: str, nullable: bool = True) -> T.StructField:
    """A string field that must hold a UUID (checked by the strict decoder)."""
    return T.StructField(name, T.StringType(), nullable, {"format": "uuid"})


def enum_field(name: str, values: list[str], nullable: bool = True) -> T.StructField:
    """A string field restricted to a closed value set."""
    return T.StructField(name, T.StringType(), nullable, {"enum": list(values)})


def offset_ts_field(name: str, nullable: bool = True) -> T.StructField:
    """An ISO-8601 timestamp that must carry a zone offset."""
    return T.StructField(name, T.TimestampType(), nullable, {"format": "offset-date-time"})


METADATA = T.StructType(
    [
        uuid_field("eid", nullable=False),
        offset_ts_field("occurred_at", nullable=False),
        T.StructField("event_type", T.StringType()),
        offset_ts_field("received_at"),
        T.StructField("parent_eids", T.ArrayType(T.StringType()), True, {"format": "uuid"}),
        T.StructField("flow_id", T.StringType()),
        T.StructField("partition", T.StringType()),
        T.StructField("partition_compaction_key", T.StringType()),
        T.StructField("span_ctx", T.MapType(T.StringType(), T.StringType())),
        T.StructField("published_by", T.StringType()),
    ]
)

CURSOR = T.StructType(
    [
        T.StructField("partition", T.StringType(), False),
        T.StructField("offset", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        uuid_field("cursor_token", nullable=False),
    ]
)

BATCH_ITEM_RESPONSE = T.StructType(
    [
        uuid_field("eid"),
        enum_field("publishing_status", PUBLISHING_STATUSES, nullable=False),
        enum_field("step", STEPS),
        T.StructField("detail", T.StringType()),
    ]
)

PROBLEM = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("title", T.StringType(), False),
        T.StructField("status", T.IntegerType(), False),
        T.StructField("detail", T.StringType()),
        T.StructField("instance", T.StringType()),
    ]
)

BASIC_SERVER_ERROR = T.StructType(
    [
        T.StructField("error", T.StringType(), False),
        T.StructField("error_description", T.StringType(), False),
    ]
)

ACL_ENTRY = T.StructType([T.StructField("data_type", T.StringType()), T.StructField("value", T.StringType())])

# Payload of the log derived from the shared ``events`` table.
EVENT_PAYLOAD = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("value", T.DoubleType(), False),
        T.StructField("k", T.LongType()),
    ]
)

def plain(schema: T.DataType) -> T.DataType:
    """The same type with field metadata stripped (for casts and DDL)."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, plain(f.dataType), f.nullable) for f in schema.fields])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(plain(schema.elementType), schema.containsNull)
    if isinstance(schema, T.MapType):
        return T.MapType(plain(schema.keyType), plain(schema.valueType), schema.valueContainsNull)
    return schema
