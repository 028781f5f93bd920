"""Registry and subscription catalog.

The registry and ACLs are dimensions (one row per event type) and are
broadcast after ``broadcast_if_bounded``; subscription lookups take a request
table and find "has all requested types" by relational division: an equi
join on (owning application, event type) and a count per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.columns import md5_uuid
from tidelog.sources.tables import broadcast_if_bounded


def event_type(registry: DataFrame, name: str) -> DataFrame:
    """S7 get: the registry row of one type (empty when unknown)."""
    return registry.filter(F.col("name") == F.lit(name))


def subscription(subscriptions: DataFrame, subscription_id: str) -> DataFrame:
    """S8 get: one subscription (empty when missing)."""
    return subscriptions.filter(F.col("id") == F.lit(subscription_id))


def _has_all(have: Column, want: Column) -> Column:  # used by list_subscriptions
    return F.size(F.array_except(want, have)) == 0


def find_subscription(subscriptions: DataFrame, requests: DataFrame) -> DataFrame:
    """J2 + L3: per request, the first matching subscription (or none).

    Match: same owning application, the subscription has every requested
    event type, and consumer_group / id equal unless the request leaves them
    null (wildcards). First = newest ``created_at``, then ``id``. ``requests``
    has ``request_id, owning_application, event_types, consumer_group, id``.

    "Has every requested type" is relational division, not a predicate over
    all (request, subscription) pairs of an application: both sides are
    exploded to (application, event type), equi-joined on that pair, and a
    subscription matches when it is hit by all of the request's distinct
    types. Only subscriptions sharing a requested type ever meet a request.
    A request must name at least one event type.
    """
    req = requests.select(
        "request_id", "owning_application", F.col("consumer_group").alias("_cg"), F.col("id").alias("_id"),
        F.array_distinct("event_types").alias("_want"))
    want = req.select("request_id", "owning_application", "_cg", "_id", F.size("_want").alias("_n"),
                      F.explode("_want").alias("_t"))
    have = subscriptions.select("id", "owning_application", "consumer_group", "created_at",
                                F.explode(F.array_distinct("event_types")).alias("_t"))
    hits = have.join(want, ["owning_application", "_t"]).filter(
        (F.col("_cg").isNull() | F.col("consumer_group").eqNullSafe(F.col("_cg")))
        & (F.col("_id").isNull() | (F.col("id") == F.col("_id"))))
    m = hits.groupBy("request_id", "id", "created_at", "_n").agg(F.count(F.lit(1)).alias("_k")) \
        .filter(F.col("_k") == F.col("_n")).select("request_id", F.col("id").alias("subscription_id"), "created_at")
    first = Window.partitionBy("request_id").orderBy(F.col("created_at").desc(), F.col("subscription_id"))
    return m.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") == 1).drop("_rn", "created_at")


def create_if_absent(subscriptions: DataFrame, requests: DataFrame, created_at: Column) -> tuple[DataFrame, DataFrame]:
    """Insert only requests without a match; returns (new table, results).

    The new table keeps every column of ``subscriptions``; what a request does
    not set is null in a new row.

    results: ``request_id, subscription_id, created`` -- the existing match, or
    the new id (md5 of the request identity, so a retried job inserts the same
    row) with ``created = true``.
    """
    found = find_subscription(subscriptions, requests)
    fresh = requests.join(found.select("request_id"), "request_id", "left_anti")
    ident = F.concat_ws("/", F.col("owning_application"), F.array_join(F.array_sort("event_types"), ","),
                        F.coalesce(F.col("consumer_group"), F.lit("")))
    new_rows = fresh.select(
        md5_uuid(ident).alias("id"), "owning_application", F.array_sort("event_types").alias("event_types"),
        "consumer_group", created_at.alias("created_at"), F.col("request_id"))
    # two identical requests must create one subscription
    new_rows = new_rows.groupBy("id").agg(
        F.first("owning_application").alias("owning_application"), F.first("event_types").alias("event_types"),
        F.first("consumer_group").alias("consumer_group"), F.first("created_at").alias("created_at"),
        F.collect_set("request_id").alias("_reqs"))
    cols = ["id", "owning_application", "event_types", "consumer_group", "created_at"]
    table = subscriptions.unionByName(new_rows.select(*cols), allowMissingColumns=True)
    results = found.withColumn("created", F.lit(False)).unionByName(
        new_rows.select(F.explode("_reqs").alias("request_id"), F.col("id").alias("subscription_id"),
                        F.lit(True).alias("created")))
    return table, results


def acl_allows(registry: DataFrame, caller_type: str, caller_value: str, role: str = "readers") -> DataFrame:
    """The event types a caller may use in ``role`` (readers / writers).

    Listed in ``role`` or in ``admins`` (administrators always may); a
    ``("*", "*")`` entry admits everybody.
    """
    entries = F.concat(F.coalesce(F.col(role), F.array()), F.coalesce(F.col("admins"), F.array()))
    ok = F.exists(entries, lambda e: ((e["data_type"] == F.lit(caller_type)) & (e["value"] == F.lit(caller_value)))
                  | ((e["data_type"] == F.lit("*")) & (e["value"] == F.lit("*"))))
    return registry.filter(ok).select(F.col("name").alias("event_type"))


def authorized_events(events: DataFrame, registry: DataFrame, caller_type: str, caller_value: str,
                      role: str = "readers") -> DataFrame:
    """Only events of types the caller is authorised for."""
    allowed = broadcast_if_bounded(acl_allows(registry, caller_type, caller_value, role))
    return events.join(allowed, "event_type", "left_semi")


def drop_deleted_types(events: DataFrame, deleted: DataFrame) -> DataFrame:
    """Deleting a type removes its events (``deleted`` has ``event_type``)."""
    return events.join(broadcast_if_bounded(deleted.select("event_type").distinct()), "event_type", "left_anti")


def with_event_type(events: DataFrame, registry: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Events joined with their registry row (left join, broadcast)."""
    reg = registry.withColumnRenamed("name", "event_type")
    if columns:
        reg = reg.select("event_type", *columns)
    return events.join(broadcast_if_bounded(reg), "event_type", "left")


def list_subscriptions(subscriptions: DataFrame, owning_application: str | None = None,
                       event_types: list[str] | None = None, limit: int | None = None,
                       offset: int = 0) -> DataFrame:
    """L1: filtered, newest first, paged. Repeated event types mean "has all"."""
    s = subscriptions
    if owning_application is not None:
        s = s.filter(F.col("owning_application") == F.lit(owning_application))
    if event_types:
        s = s.filter(_has_all(F.col("event_types"), F.array(*[F.lit(t) for t in event_types])))
    s = s.orderBy(F.col("created_at").desc(), F.col("id"))
    if offset:
        s = s.offset(offset)
    if limit is not None:
        s = s.limit(limit)
    return s


def page_links(subscriptions: DataFrame, limit: int, offset: int, owning_application: str | None = None,
               event_types: list[str] | None = None) -> DataFrame:
    """L2: whether a previous / next page exists (one row)."""
    s = list_subscriptions(subscriptions, owning_application, event_types)
    return s.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.lit(offset > 0).alias("has_prev"), (F.col("total") > F.lit(offset + limit)).alias("has_next"))


def retention_filter(log: DataFrame, registry: DataFrame, as_of: Column, ts_col: str = "ts") -> DataFrame:
    """P20: types with cleanup ``delete`` keep only events younger than the
    retention time (milliseconds) at ``as_of``; other types keep everything."""
    reg = broadcast_if_bounded(registry.select(F.col("name").alias("event_type"), "cleanup_policy",
                                               "retention_time_ms"))
    j = log.join(reg, "event_type", "left")
    cutoff = as_of - F.make_dt_interval(secs=(F.col("retention_time_ms") / F.lit(1000.0)).cast("decimal(18,6)"))
    keep = ~F.col("cleanup_policy").eqNullSafe(F.lit("delete")) | F.col("retention_time_ms").isNull() \
        | (F.col(ts_col).cast("timestamp") >= cutoff)
    return j.filter(keep).drop("cleanup_policy", "retention_time_ms")


def scope_allowed(scopes: Column, session_scopes: list[str]) -> Column:
    """A null or empty scope list admits everyone; else one must match."""
    have = F.array(*[F.lit(s) for s in session_scopes]) if session_scopes else F.array().cast("array<string>")
    return scopes.isNull() | (F.size(scopes) == 0) | F.arrays_overlap(scopes, have)


def compact_latest(log: DataFrame, key_col: str = "partition_compaction_key",
                   order_col: str = "offset") -> DataFrame:
    """Latest event per (event_type, partition, compaction key).

    ``max_by`` aggregates partially on the map side, so a hot key costs one
    row per task before the shuffle. Events without a key are all kept: their
    offset stands in for it, so the log is read once.
    """
    keys = ["event_type", "partition", key_col]
    other = [c for c in log.columns if c not in keys]
    alone = log.withColumn("_alone", F.when(F.col(key_col).isNull(), F.col(order_col)))
    return alone.groupBy(*keys, "_alone").agg(F.max_by(F.struct(*other), F.col(order_col)).alias("_l")) \
        .select(*keys, "_l.*").select(*log.columns)


def order_in_instance(df: DataFrame, instance: list[str], keys: list[str], arrival: list[str]) -> DataFrame:
    """Rank by the ordering key within each instance and flag rows that
    arrive after a row with a larger key (out of order).

    Adds ``key_rank`` (by keys), ``arrival_rank`` (by arrival order) and
    ``out_of_order``. Windows are per instance (an entity), not per log.
    """
    by_key = Window.partitionBy(*instance).orderBy(*keys, *arrival)
    by_arrival = Window.partitionBy(*instance).orderBy(*arrival, *keys)
    before = by_arrival.rowsBetween(Window.unboundedPreceding, -1)
    key = F.struct(*keys)
    return df.withColumn("key_rank", F.row_number().over(by_key).cast("bigint")) \
        .withColumn("arrival_rank", F.row_number().over(by_arrival).cast("bigint")) \
        .withColumn("out_of_order", F.coalesce(F.max(key).over(before) > key, F.lit(False)))
